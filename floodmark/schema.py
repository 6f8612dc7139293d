"""Fixed schemas."""

from pyspark.sql import types as T

_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()

# The 32 inventory columns and their types, in order.
INVENTORY = T.StructType([
    T.StructField("bid", _S), T.StructField("bldgtype", _S), T.StructField("cbfips", _S),
    T.StructField("fd_id", _L), T.StructField("firmzone", _S), T.StructField("found_ht", _D),
    T.StructField("found_type", _S), T.StructField("ftprntid", _S), T.StructField("ftprntsrc", _S),
    T.StructField("ground_elv", _D), T.StructField("ground_elv_m", _D), T.StructField("med_yr_blt", _L),
    T.StructField("num_story", _L), T.StructField("o65disable", _D), T.StructField("occtype", _S),
    T.StructField("pop2amo65", _L), T.StructField("pop2amu65", _L), T.StructField("pop2pmo65", _L),
    T.StructField("pop2pmu65", _L), T.StructField("source", _S), T.StructField("sqft", _D),
    T.StructField("st_damcat", _S), T.StructField("students", _L), T.StructField("u65disable", _D),
    T.StructField("val_cont", _D), T.StructField("val_struct", _D), T.StructField("val_vehic", _L),
    T.StructField("x", _D), T.StructField("y", _D), T.StructField("longitude", _D),
    T.StructField("latitude", _D), T.StructField("processed_at", T.TimestampType()),
])
GEOMETRY_COLUMNS = {"x": "longitude", "longitude": "longitude", "y": "latitude", "latitude": "latitude"}
PROPERTY_COLUMNS = [f.name for f in INVENTORY if f.name not in GEOMETRY_COLUMNS and f.name != "processed_at"]

# Attributes kept by the feature-stream client.
STREAM_COLUMNS = [
    "bid", "occtype", "val_struct", "sqft", "num_story", "found_type", "found_ht", "val_cont", "cbfips",
    "pop2pmu65", "pop2pmo65",
]
REQUIRED_PARTITIONED = ["cbfips", "bid", "longitude", "latitude"]

# Columns of an engine prediction file, read by name.
PREDICTIONS = T.StructType([
    T.StructField("FltyId", _S), T.StructField("Occ", _S), T.StructField("Cost", _D), T.StructField("Area", _D),
    T.StructField("NumStories", _D), T.StructField("FoundationType", _D), T.StructField("FirstFloorHt", _D),
    T.StructField("ContentCost", _D), T.StructField("Latitude", _D), T.StructField("Longitude", _D),
    T.StructField("Depth_Grid", _D), T.StructField("Depth_in_Struc", _D), T.StructField("flExp", T.IntegerType()),
    T.StructField("SOID", _S), T.StructField("BDDF_ID", _S), T.StructField("BldgDmgPct", _D),
    T.StructField("BldgLossUSD", _D), T.StructField("ContentCostUSD", _D), T.StructField("CDDF_ID", _S),
    T.StructField("ContDmgPct", _D), T.StructField("ContentLossUSD", _D), T.StructField("InventoryCostUSD", _D),
    T.StructField("IDDF_ID", _S), T.StructField("InvDmgPct", _D), T.StructField("InventoryLossUSD", _D),
    T.StructField("DebrisID", _S), T.StructField("Debris_Fin", _D), T.StructField("Debris_Struc", _D),
    T.StructField("Debris_Found", _D), T.StructField("Debris_Tot", _D), T.StructField("Restor_Days_Min", _L),
    T.StructField("Restor_Days_Max", _L), T.StructField("GridName", _S),
])
