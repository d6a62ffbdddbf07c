"""DataFrame -> DataFrame operators of the silver, gold and serving layers."""
