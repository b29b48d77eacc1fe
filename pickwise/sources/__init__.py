"""Table scans and the five DataFrame shapes built from them."""

from pickwise.sources.tables import (TABLE_SCHEMAS, articles, catalog, check_schema,
                                     event_weights, interactions, load, publish,
                                     published, ratings)

__all__ = ["TABLE_SCHEMAS", "articles", "catalog", "check_schema", "event_weights",
           "interactions", "load", "publish", "published", "ratings"]
