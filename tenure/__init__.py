"""tenure: entity-survival analytics on Spark.

Licence-style interval records and geolocated service requests become a
monthly business panel; survival datasets, feature selection, logistic and
Cox models, profile scoring, GeoJSON export and incremental ingest are all
DataFrame / SQL / MLlib work.
"""

from tenure.config import PanelSettings, ModelSettings

__all__ = ["PanelSettings", "ModelSettings"]
