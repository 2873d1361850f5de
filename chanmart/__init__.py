"""chanmart: a Spark-native warehouse for channel messages and their images.

Raw JSON message files and image files are loaded once each into raw tables,
images go through a caller-supplied detector, staging and mart models shape a
small star schema, declarative checks test it, and report queries answer
search / top-term / activity / top-object questions as lazy DataFrames.
"""

__version__ = "0.1.0"
