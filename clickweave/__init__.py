"""Analytics operators for click logs, text and relational tables on PySpark."""
