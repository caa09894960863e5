"""Message-shaped data integration operators on Spark DataFrames."""
