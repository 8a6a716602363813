"""wareflow: retail-page analytics as functions from DataFrames to DataFrames."""
