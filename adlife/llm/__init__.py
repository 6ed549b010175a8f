"""Training-data operators: ten corpus operators and the queries over them.

Nothing else in the library imports this subpackage; it may use the general
helpers of :mod:`adlife.session`.
"""
