"""Sleep-staging analytics expressed as Spark DataFrame transformations."""
