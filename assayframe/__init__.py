"""assayframe: assay text files to deduplicated long tables, on Spark DataFrames."""
