"""Inputs whose results are known from elsewhere."""

# --- fixed values ------------------------------------------------------------------
BEIJING = "POLYGON((116.0 39.0, 117.0 39.0, 117.0 40.0, 116.0 40.0, 116.0 39.0))"
HERE = "39.9, 116.4"
NEAR_HERE = "39.9001, 116.4001"
EAST = "40.0, 117.0"
LEVELS = (8, 10)
CHILD_LEVEL, CHILDREN = 12, 256
# ------------------------------------------------------------------------------------
