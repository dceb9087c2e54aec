"""Column names of the incident table the default settings are for."""

# fixed values: columns kept after cleaning
KEPT = (
    "incident_meridian",
    "incident_range",
    "incident_township",
    "incident_section",
    "incident_number",
    "incident_lsd",
    "volume_released",
    "volume_recovered",
    "injury_count",
    "fatality_count",
    "licensee_name",
    "field_centre",
    "incident_notification_date",
    "incident_type",
    "incident_date",
    "geometry_point",
    "location_1",
    "location",
    "source",
    "failure_type",
    "cause_type",
    "cause_category",
    "licensee_id",
    "area_affected",
    "wildlife_livestock_affected",
    "public_affected",
    "sensitive_area",
    "release_offsite",
    "incident_complete_date",
    "strike_area",
    "substance_released",
    "volume_units",
    "release_cleanup_date",
    "environment_affected",
    "jurisdiction",
    "licence_type",
    "licence_number",
)

# fixed values: columns dropped before encoding
DROPPED = (
    "licensee_name",
    "field_centre",
    "incident_notification_date",
    "incident_date",
    "geometry_point",
    "location_1",
    "location",
    "incident_complete_date",
    "release_cleanup_date",
    "licence_number",
)

# fixed values: the key, and the counts that define the label
KEY = "incident_number"
CAUSES = ("injury_count", "fatality_count")

# fixed values: two-valued columns, and columns with few values
BINARY = ("release_offsite", "sensitive_area", "volume_units")
ONE_HOT = (
    "area_affected",
    "cause_category",
    "environment_affected",
    "fatality_count",
    "incident_meridian",
    "injury_count",
    "licence_type",
    "public_affected",
    "wildlife_livestock_affected",
)

# fixed values: numeric columns
NUMERIC = (
    "incident_lsd",
    "volume_units",
    "incident_range",
    "volume_released",
    "source",
    "incident_meridian",
    "jurisdiction",
    "incident_section",
    "public_affected",
    "licence_type",
    "injury_count",
    "area_affected",
    "sensitive_area",
    "volume_recovered",
    "fatality_count",
    "strike_area",
    "incident_number",
    "cause_category",
    "incident_township",
    "cause_type",
    "environment_affected",
    "substance_released",
    "release_offsite",
    "wildlife_livestock_affected",
    "failure_type",
    "licensee_id",
)
