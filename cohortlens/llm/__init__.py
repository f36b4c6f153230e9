"""Operators of a training-data pipeline. One module per operator; ``queries``
holds the registered queries, ``oracle`` their SQL where SQL can express them."""
