"""End-to-end programs (tweets -> topics, weather + tweets -> tree, JSON -> SQL, examples) and
the registry of named queries over the deployment's tables."""
