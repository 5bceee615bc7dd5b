"""Column contracts, thresholds, vocabularies and names that results depend on."""

CONTRACT_COLUMNS = [
    "latitude", "longitude", "acq_date", "acq_time", "satellite", "bright_ti4", "bright_ti5", "frp",
    "confidence", "daynight", "dist_to_industrial_m", "osm_industrial_tag",
    "dist_to_flare_capable_m", "nearest_flare_facility_type",
    "dist_to_heat_industry_m", "nearest_heat_facility_type",
    "dist_to_coal_mine_m", "nearest_coal_source", "dist_to_brick_kiln_m",
    "landcover_class", "recurrence_count", "first_seen", "last_seen", "is_anomalous", "label", "label_source",
]
# Of the contract's columns; the others are strings.
CONTRACT_TYPES = {
    **dict.fromkeys(["latitude", "longitude", "bright_ti4", "bright_ti5", "frp"], "double"),
    **dict.fromkeys([c for c in CONTRACT_COLUMNS if c.startswith("dist_")], "double"),
    "landcover_class": "int", "recurrence_count": "long", "is_anomalous": "boolean",
}
REQUIRED_COLUMNS = ["latitude", "longitude", "acq_date", "acq_time", "satellite", "bright_ti4", "bright_ti5", "frp", "confidence", "daynight"]
CLASSES = ["industrial", "gas flare", "agricultural burning", "wildfire", "unknown"]
GRID = 0.0034

# Facility types near which flares, or steady heat, are expected.
FLARE_TYPES = ["oil_gas_power_plant", "oil_gas_field", "lng_terminal", "chemical_plant"]
HEAT_TYPES = ["cement_plant", "steel_plant", "coal_power_plant", "coal_mine", "chemical_plant"]
CRITICAL_TYPES = [
    "refinery", "chemical_plant", "oil_gas_power_plant", "coal_power_plant", "lng_terminal", "oil_gas_field", "cement_plant", "steel_plant",
]
THERMAL_FUELS = ["coal", "gas", "oil", "diesel", "nuclear"]
NEVER_DUG = ["proposed", "announced", "cancelled", "shelved"]
CROPLAND, NATURAL = [40], [10, 20, 30]
LANDCOVER_NAMES = {
    10: "Tree cover", 20: "Shrubland", 30: "Grassland", 40: "Cropland", 50: "Built-up", 60: "Bare / sparse vegetation",
    70: "Snow and ice", 80: "Permanent water bodies", 90: "Herbaceous wetland", 95: "Mangroves", 100: "Moss and lichen",
}
SUBTYPES = [
    "Refinery / oil & gas", "Thermal power plant", "Mine / coal-seam fire", "Steel", "Cement", "Chemical / petrochemical", "Not identified",
]
FACILITY_SUBTYPE = {
    "oil_gas_field": "Refinery / oil & gas", "lng_terminal": "Refinery / oil & gas", "coal_power_plant": "Thermal power plant",
    "oil_gas_power_plant": "Thermal power plant", "coal_mine": "Mine / coal-seam fire", "steel_plant": "Steel",
    "cement_plant": "Cement", "chemical_plant": "Chemical / petrochemical",
}
TAG_SUBTYPE = {
    "refinery": "Refinery / oil & gas", "oil": "Refinery / oil & gas", "oil_storage": "Refinery / oil & gas",
    "petroleum_terminal": "Refinery / oil & gas", "gas": "Refinery / oil & gas", "gas_plant": "Refinery / oil & gas",
    "natural_gas": "Refinery / oil & gas", "gas_storage": "Refinery / oil & gas", "mine": "Mine / coal-seam fire",
    "steel": "Steel", "steel_mill": "Steel", "steelmaking": "Steel", "cement": "Cement", "cement_plant": "Cement",
    "chemical": "Chemical / petrochemical", "petrochemical": "Chemical / petrochemical",
}
CONFIDENCE_ORDINAL = {"l": 0, "low": 0, "n": 1, "nominal": 1, "h": 2, "high": 2}
# Classes in the order in which a map draws them, first drawn first.
DRAW_ORDER = ["unknown", "agricultural burning", "wildfire", "industrial", "gas flare"]
# What a model sees, in its order.
FEATURES = [
    "bright_ti4", "bright_ti4_missing", "bright_ti5", "bright_ti5_missing", "frp", "frp_missing", "confidence_ordinal",
    "dist_to_industrial_m", "dist_to_industrial_m_missing", "dist_to_flare_capable_m", "dist_to_flare_capable_m_missing",
    "dist_to_heat_industry_m", "dist_to_heat_industry_m_missing", "recurrence_count", "is_anomalous",
    "satellite__N", "satellite__1", "satellite__2", "satellite__other", "daynight__D", "daynight__N", "daynight__other",
    "landcover_class__10", "landcover_class__20", "landcover_class__30", "landcover_class__40", "landcover_class__50", "landcover_class__60",
    "landcover_class__70", "landcover_class__80", "landcover_class__90", "landcover_class__95", "landcover_class__100", "landcover_class__other",
    "nearest_flare_facility_type__oil_gas_power_plant", "nearest_flare_facility_type__oil_gas_field", "nearest_flare_facility_type__lng_terminal",
    "nearest_flare_facility_type__chemical_plant", "nearest_flare_facility_type__other",
    "nearest_heat_facility_type__cement_plant", "nearest_heat_facility_type__steel_plant", "nearest_heat_facility_type__coal_power_plant",
    "nearest_heat_facility_type__coal_mine", "nearest_heat_facility_type__chemical_plant", "nearest_heat_facility_type__other",
]
