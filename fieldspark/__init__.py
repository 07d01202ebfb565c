"""fieldspark: a PySpark-native analytics engine for nested sports feeds and for text corpora."""
