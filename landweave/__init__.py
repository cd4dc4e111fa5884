"""Land-cover chip analytics as DataFrame plans over all areas of interest at once."""
