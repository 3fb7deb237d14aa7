"""Job plans: the end-to-end jobs (U2) and the registered query catalog."""
