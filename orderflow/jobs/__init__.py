"""Entry points for spark-submit; each takes one configuration file."""
