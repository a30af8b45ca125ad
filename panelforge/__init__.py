"""Research-panel preparation, checking and analytics as PySpark DataFrame operators."""
