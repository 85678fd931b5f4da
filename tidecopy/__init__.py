"""tidecopy: keep analytical copies of database tables up to date on Spark.

Map a source column catalog to target types, load tables in full or in date
chunks, upsert new and changed rows by key, and check counts against the
source; every step is a DataFrame operator."""

from tidecopy.spec import ChunkSpec, SpecError, TableSpec

__all__ = ["ChunkSpec", "SpecError", "TableSpec"]
__version__ = "0.1.0"
