"""The data products and their checks, profiles, model training and report frames."""
