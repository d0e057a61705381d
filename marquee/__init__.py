"""marquee: layered title / people / genre / series analytics as PySpark DataFrames."""
