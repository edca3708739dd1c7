"""Column functions: bands, callsigns, grids, numbers, times and space weather."""
