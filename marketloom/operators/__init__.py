"""The layers of the model, each a function from DataFrames to a DataFrame."""
