"""tidemark: incremental JSON ingest, keyed upsert, change-driven flattening and serving on Spark.

Records arrive as paged JSON, are folded and upserted into a landing table keyed by
``hash``, and only the records that changed are flattened into a typed table that
reports read. Every operator is a plain ``DataFrame -> DataFrame`` function; only
``plans`` and ``streaming`` touch storage.
"""

from tidemark.session import prepare, shared_dir
from tidemark.schema import ENVELOPE_KEY, FIELD_MAP, FLAT_SCHEMA, LANDING_SCHEMA

__all__ = ["prepare", "shared_dir", "ENVELOPE_KEY", "FIELD_MAP", "FLAT_SCHEMA", "LANDING_SCHEMA"]
