"""loadsplit: Spark-native analytics for 15-minute electricity interval data.

Layers (all lazy DataFrame plans over Parquet/CSV):

* ``sources``   readers for meter/weather CSVs, sinks, and the driver views
* ``functions`` column-expression builders (parsing, calendar, numeric, bands)
* ``operators`` DataFrame -> DataFrame stages (ingest, quality, weather,
  features, model, attribution, export, bands, reports)
* ``plans``     pipelines P1-P6 and the query registry used by the driver
* ``streaming`` incremental file pickup with ``trigger(availableNow=True)``
"""

__version__ = "0.1.0"
