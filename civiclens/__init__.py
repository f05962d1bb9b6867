"""Spark-native operators for messy open-data tables.

Every operator takes and returns a lazy ``DataFrame`` or ``Column``. The
exceptions, which run a job while the plan is built, say so in their docstring:
writers, the size checks and hot keys of :mod:`civiclens.operators.joins`, the
cell descent of :mod:`civiclens.operators.nearest`, and the strict income
loader, which looks up its header line.
"""
