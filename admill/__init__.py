"""admill: creative-intelligence analytics as Spark DataFrame operators."""
