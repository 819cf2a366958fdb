"""cardweave: card-payment message processing as Spark DataFrame jobs."""
