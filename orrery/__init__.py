"""One trustworthy entity table out of several overlapping measurement sources."""
