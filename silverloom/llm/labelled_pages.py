"""Pages that the extraction model learns from. ``data-y`` says for an element and what lies in it whether it is main text."""

_LONG = ("The river rose for the third day and the lower fields were under water by noon. Farmers moved their cattle to the "
         "hills, and the ferry stopped for the first time since the flood of the year before. Nobody was hurt.")
_MID = "The council meets again on Monday, and the plan is open to the public until the end of the month."
_SHORT = "It went on."

PAGES = (
    # article with menu, advert, footer
    f"""<html><body><nav><ul><li><a>Home</a></li><li><a>News</a></li><li>Sport</li></ul></nav><div class="ad">{_MID}</div>
    <article data-y="1"><h1>Flood</h1><p>{_LONG}</p><p>{_SHORT}</p><p>{_MID}</p></article><footer>Contact {_SHORT}</footer></body></html>""",
    f"""<html><body><header><h1>The Paper</h1><p>{_SHORT}</p></header><nav><a>One</a><a>Two</a></nav><main><article data-y="1">
    <h1>Title</h1><h2>Part</h2><p>{_MID}</p><ul><li>{_SHORT}</li><li>{_MID}</li></ul><blockquote><p>{_MID}</p></blockquote>
    <aside data-y="0"><p>{_MID}</p></aside><p>{_LONG}</p></article></main><aside class="sidebar"><h3>More</h3><ul><li><a>A</a></li></ul><p>{_LONG}</p></aside>
    <section id="comments" class="comments"><h3>Comments</h3><article class="comment"><p>{_MID}</p></article><div class="comment"><p>{_LONG}</p></div></section>
    <footer><p>{_LONG}</p></footer></body></html>""",
    # text in a div, notices, forms
    f"""<html><body><div class="cookie-notice banner notice"><p>{_LONG}</p></div><div id="header"><div class="menu"><ul><li>One</li></ul></div></div>
    <div id="wrapper"><div class="content post" data-y="1"><h1>Title</h1><p>{_MID}</p><p>{_SHORT}</p><div class="ad advert" data-y="0">{_MID}</div>
    <table><tr><td>{_SHORT}</td><td>{_SHORT}</td></tr></table><pre>{_SHORT}</pre></div><div class="sidebar widget"><p>{_MID}</p></div></div>
    <form class="newsletter"><p>{_MID}</p></form><div id="footer" class="footer"><p>{_MID}</p></div></body></html>""",
    f"""<html><body><div class="topbar nav menu"><p>{_SHORT}</p></div><div id="main-content" class="entry article-body" data-y="1"><p>{_LONG}</p><p>{_MID}</p>
    <h3>{_SHORT}</h3><p>{_SHORT}</p><figure><figcaption>{_SHORT}</figcaption></figure><form data-y="0"><p>{_SHORT}</p></form></div>
    <div class="related links"><ul><li><a>{_MID}</a></li><li><a>{_MID}</a></li></ul></div><div class="share social"><p>{_SHORT}</p></div>
    <div class="comments-list discussion"><div class="comment reply"><p>{_LONG}</p></div></div><div class="ads sponsored promo">{_LONG}</div></body></html>""",
    # nothing but paragraphs
    f"""<html><body><p data-y="1">{_LONG}</p><p data-y="1">{_SHORT}</p><p data-y="1">{_MID}</p></body></html>""",
    f"""<body><h1 data-y="1">Title</h1><p data-y="1">{_MID}</p><ul data-y="1"><li>{_MID}</li><li>{_SHORT}</li></ul><footer><p>{_MID}</p></footer></body>""",
    # articles of one block, or of bare text
    f"""<html><body><nav><ul><li><a>Home</a></li></ul></nav><article data-y="1"><p>{_SHORT}</p></article><div class="ad">{_SHORT}</div>
    <section class="comments"><article class="comment"><p>{_SHORT}</p></article></section><aside class="sidebar"><p>{_SHORT}</p></aside></body></html>""",
    f"""<html><body><header><p>{_SHORT}</p></header><div class="cookie notice">{_MID}</div><article data-y="1"><p>{_MID}</p></article><footer>{_SHORT}</footer></body></html>""",
    f"""<html><body><div class="menu">{_SHORT}</div><article data-y="1">{_LONG}</article><footer>{_SHORT}</footer></body></html>""",
    f"""<html><body><article data-y="1"><div><div><div>{_SHORT}</div></div></div></article><div><div class="sponsored">{_MID}</div></div></body></html>""",
    f"""<html><body><nav>{_SHORT}</nav><article data-y="1"><ul><li>{_SHORT}</li></ul><ol><li>{_MID}</li></ol><dl><dt>{_SHORT}</dt><dd>{_SHORT}</dd></dl>
    <table><thead><tr><th>{_SHORT}</th></tr></thead><tbody><tr><td>{_MID}</td></tr></tbody></table><h4>{_SHORT}</h4><h5>{_SHORT}</h5><h6>{_SHORT}</h6></article></body></html>""",
    f"""<html><body><article data-y="1">{"<div>" * 10}{_SHORT}{"</div>" * 10}<p>{_MID}</p></article></body></html>""",
    f"""<html><body><div><div><article data-y="1">{"<div>" * 6}<p>{_SHORT}</p>{"</div>" * 6}</article></div></div></body></html>""",
    # articles of a heading and a line
    f"""<html><body><nav><ul><li><a>Home</a></li></ul></nav><div class="ad">{_LONG}</div><article data-y="1"><h1>Title</h1><p>{_SHORT}</p></article>
    <footer>{_LONG}</footer></body></html>""",
    f"""<html><body><article data-y="1"><div><section><p>{_MID}</p><div>{_SHORT}</div></section></div><footer data-y="0">{_SHORT}</footer>
    <nav data-y="0"><p>{_SHORT}</p></nav><header data-y="0"><p>{_SHORT}</p></header><p><a>{_MID}</a></p><div class="comments" data-y="0"><p>{_MID}</p></div></article>
    <div class="popup modal notice alert"><p>{_MID}</p></div><div class="breadcrumb pagination"><p>{_SHORT}</p></div></body></html>""",
    f"""<html><body><main data-y="1"><h1>Title</h1><section><h2>Part</h2><p>{_LONG}</p></section><section><p>{_MID}</p><p>{_SHORT}</p></section></main>
    <aside><p>{_MID}</p></aside><section class="comments" id="respond"><form><p>{_SHORT}</p></form><p>{_LONG}</p></section></body></html>""",
)
