"""Inputs and sinks: raw tables derived from the driver's tables
(``derived``), header-aware CSV landing folders (``landing``), balanced and
range-clustered parquet tables (``store``)."""
