"""Word evidence as Spark DataFrames: which candidate words do independent collections attest?"""
