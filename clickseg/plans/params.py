"""Parameters of the registered check queries."""

# Salt of the registered check queries only; real runs pass their own secret.
CHECK_SALT = "salt"

# The adapter's monthly input files.
SOURCE_FILES = ["2024-01-a", "2024-01-b", "2024-01-c"]

# Segment table of the check queries (callers pass their own): the cluster numbers and
# names are fixed values that must equal the reference's.
SEGMENTS = [
    {"cluster": 0, "name": "Clients Dormants",
     "description": "Long since the last purchase; few but fair-sized baskets.",
     "strategy": "Win back with a limited offer."},
    {"cluster": 1, "name": "Clients Actifs Moyens",
     "description": "Recent and regular purchases with large baskets.",
     "strategy": "Reward loyalty and suggest matching products."},
]
