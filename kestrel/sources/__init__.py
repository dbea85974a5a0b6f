"""Sources: landed raw responses -> typed entity frames; table reads."""
