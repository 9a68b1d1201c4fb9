"""Domain recipes: each is a function of parent DataFrames returning a lazy DataFrame (UD1)."""
