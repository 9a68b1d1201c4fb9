"""homesense: in-home sensor and health time series, expressed as Spark DataFrame plans.

Sub-packages
------------
functions   Column builders (time of day, angles, bins, time zones, rounding, maps, text).
operators   DataFrame -> DataFrame operators (transitions, resampling, segmentation, stats, joins).
sources     Readers, sinks, declared schemas and the dataset catalogue.
plans       Composite recipes (base / profile / bed_habits / legacy domains) and the driver-table queries.
streaming   Structured Streaming twins of the incremental jobs.
"""

__version__ = "0.1.0"
