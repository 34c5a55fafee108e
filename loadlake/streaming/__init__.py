"""The batch operators fed by streams.

The lake is built in batches; these are the same steps for files that keep arriving.
"""
