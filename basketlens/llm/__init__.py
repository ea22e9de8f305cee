"""Training-data operators: each module builds one, ``queries`` registers them."""
