"""tripmill: trip-record analytics on PySpark, from raw files to served answers."""
