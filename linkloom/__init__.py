"""Entity linking and text-corpus preparation on Spark."""
