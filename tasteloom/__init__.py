"""Ratings analytics and recommendations as plain PySpark DataFrame operators."""
