"""Climate-exposure analytics as plain DataFrame-to-DataFrame Spark operators."""
