"""Filing tables derived from generic order, customer and page tables.

Used by the registered queries, the tests and the benchmark.
"""
