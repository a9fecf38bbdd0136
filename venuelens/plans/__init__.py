"""Views over the supplied tables, whole pipelines and the registered queries."""
