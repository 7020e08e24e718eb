"""Fixed schemas of the measurement tables."""

#: The exported table, in order (fixed values: names and types of the public result format).
OUTPUT = [
    ("material_name", "string"), ("frequency_mhz", "double"), ("temperature_c", "double"), ("dielectric_constant", "double"),
    ("loss_factor", "double"), ("loss_tangent", "double"), ("moisture_content_pct", "double"), ("moisture_basis", "string"),
    ("salt_content", "string"), ("electrical_conductivity_s_m", "double"), ("paper_id", "string"), ("paper_uid", "string"),
    ("doi", "string"), ("source_table", "string"), ("source_location", "string"), ("data_provenance", "string"),
    ("model_expression", "string"), ("model_r_squared", "double"), ("extraction_source", "string"), ("extraction_model", "string"),
    ("title", "string"), ("authors", "string"), ("year", "int"), ("journal", "string"), ("measurement_method", "string"),
]
COLUMNS = [c for c, _ in OUTPUT]
OUTPUT_SCHEMA = ", ".join(f"{c} {t}" for c, t in OUTPUT)

#: Columns an audit flag carries from its record, and its own (fixed values).
FLAG_FROM_RECORD = [
    "paper_key", "paper_uid", "paper_id", "doi", "title", "material_name", "frequency_mhz", "temperature_c", "moisture_content_pct",
    "moisture_basis", "salt_content", "electrical_conductivity_s_m", "source_table", "source_location", "data_provenance",
]
FLAG_OWN = ["severity", "rule_id", "description", "current_value", "expected_range"]
