"""slotplan: a Spark-native ETL and slot planner.

Raw catalogue rows (recipes, appliances, level tables, pages) are cleaned into
typed columns, joined, scored, and turned into "best item per return-time slot"
reports. Everything is a DataFrame transformation that Catalyst optimises.
"""

__version__ = "0.1.0"
