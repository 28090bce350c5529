"""Cell-grid and raster analytics as Spark DataFrame operations."""

from . import session

session.ship()
