"""gridlake: utility grid data (feeders, hosting capacity, distributed energy
resources) on Spark — landing CSV ingestion, cleansing, conformed Gold
tables, serving views and data-quality reports, all as DataFrame plans."""

__version__ = "0.1.0"
