"""tillstream: change-data-capture warehouse operators for retail data on Spark."""
