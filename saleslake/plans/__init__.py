"""The models of each layer, and the order in which a lake is built."""
