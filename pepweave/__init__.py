"""pepweave: protein-variant graph queries and peptide-set comparison on Spark DataFrames."""
