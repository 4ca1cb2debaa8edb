"""Bronze, Silver and Gold layers of bank transactions as Spark DataFrames."""
