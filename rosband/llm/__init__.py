"""Operators for training-data pipelines over ``documents`` and ``pages``.

One module per operator, each with a general DataFrame-in, DataFrame-out interface;
``queries`` holds the registered queries over the test tables and ``oracles`` their SQL.
"""
