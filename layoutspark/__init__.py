"""Spark-native analytics for page layout data: OCR lines, boxes, blocks, regions."""
