"""fleetspark: vehicle-logistics analytics on Spark (batch and streaming).

Modules are imported explicitly (``from fleetspark.plans import silver``);
nothing here touches a Spark session at import time.
"""

__version__ = "0.1.0"
