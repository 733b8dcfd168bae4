"""codesift: mining source code for security weaknesses with Spark."""
