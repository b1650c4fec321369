"""The reports: each is a function from source DataFrames to a result DataFrame.

Frames carry their day in ``dt`` (yyyymmdd) and every rule that belongs to a day is keyed
by it, so a call covers one day or many, and many days at once give the rows of the days
run one by one. Passing a day range is also how missed days are caught up.
"""
