"""glyphmill: a PySpark-native engine for diacritized text: corpora, lexicons, quotations and mark restoration."""
