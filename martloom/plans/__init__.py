"""The OLAP reports and the views built on them."""
