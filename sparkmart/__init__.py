"""sparkmart: a Spark-native retail star-schema warehouse.

Sources (CSV masters, transaction files and streams) are cleaned, joined and
loaded into five dimensions and one fact table; OLAP reports and data-quality
checks run on the loaded star as DataFrame / SQL jobs.
"""

__version__ = "0.1.0"
