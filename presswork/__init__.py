"""presswork: mining large news-text collections with Spark DataFrames."""
