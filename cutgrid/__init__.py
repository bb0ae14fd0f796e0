"""cutgrid: restriction-site sequencing analytics as plain Spark DataFrame jobs."""
