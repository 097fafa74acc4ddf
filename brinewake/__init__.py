"""Maritime acoustic analytics on Spark."""
