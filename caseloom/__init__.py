"""caseloom: incident-report analytics expressed as Spark DataFrame transformations."""
