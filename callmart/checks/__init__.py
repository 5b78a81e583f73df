"""Every operator and pipeline as a query over the driver tables, with its SQL meaning."""
