"""Document reconstruction on Spark: pages, lines, blocks, chapters, corrections and checks as DataFrames."""
