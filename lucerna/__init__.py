"""Part of lucerna, an entity-resolution and data-quality engine on PySpark."""
