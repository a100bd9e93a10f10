"""Time-series operators.

Windows never take a whole series: rows are cut into blocks of a fixed number of
slots, a window runs inside (series, block), and what must cross a block border is
either copied (a halo of the few rows a lag needs) or carried (one summary row per
block). A series of any size therefore spreads over many tasks.
"""
