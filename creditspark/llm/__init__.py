"""Training-data pipeline operators (URL filters, packing, decontamination, ...)."""
