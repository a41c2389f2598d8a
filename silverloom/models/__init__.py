"""The warehouse models: silver tables conform and stack the source systems, gold tables resolve, enrich and report."""
