"""gridloom: Spark-native extraction, cleaning, typing and linking of tables."""
