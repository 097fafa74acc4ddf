"""Operators for large-scale training-data preparation.

Nothing outside this subpackage imports it.  Executors must be able to import ``brinewake``
(installed, or on ``PYTHONPATH`` / ``--py-files``), because the Arrow functions here are
pickled by reference.
"""
