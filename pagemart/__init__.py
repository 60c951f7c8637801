"""Page tables to historised relational tables, as Spark jobs."""
