"""Ready-made parameters for particular data sets."""
