"""odsflow: fill, check and summarise the landing layer of a warehouse with Spark."""
