"""Domain models M1-M10 as DataFrame -> DataFrame functions."""
