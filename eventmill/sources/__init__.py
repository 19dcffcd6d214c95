"""Sources: driver tables, the raw-event adapter, modelled metric inputs, stream sources."""
