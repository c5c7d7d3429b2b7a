"""DataFrame -> DataFrame building blocks; all of them are lazy."""
