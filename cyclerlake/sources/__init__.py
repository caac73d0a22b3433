"""Where records come from: table collections, declared schemas, the test catalogue."""
