"""Types of the records that operators exchange."""

CANONICAL_RECORD = """
support struct<municipality:string,year:int,month:int,date:date>, support_role string, event_type string,
source struct<system:string,dataset:string,file:string>, code_roles map<string,array<string>>,
subgroups map<string,string>, continuous map<string,double>, annotations map<string,array<string>>,
weight double, quality struct<included:boolean,flags:array<string>>, provenance map<string,string>
"""
SCAN_ENTRY = """
parent_directory string, child_name string, full_path string, entry_type string, size long, modified string,
listing_method string, scan_timestamp double, worker_id int, error_flags array<string>
"""
FIELD_PROFILE = "path string, name string, primitive_type string, non_null long, nulls long, distinct_seen long, samples array<string>, signals array<string>"
VALUE_ROW = """
aggregate_id long, variable_id string, variable_name string, locality_id string, locality_name string, period_id string,
period_name string, value double, raw_value string, dimensions map<string,struct<code:string,name:string>>
"""
#: Tables of the metadata catalogue: columns and primary key.
CATALOG = {
    "agregados": ("id long, nome string, pesquisa string, assunto string, url string, freq string, periodo_inicio string, periodo_fim string, municipality_locality_count long, covers_national_municipalities boolean", ["id"]),
    "agregados_levels": ("agregado_id long, level_id string, level_name string, locality_count long", ["agregado_id", "level_id"]),
    "variables": ("agregado_id long, id string, nome string, unidade string", ["agregado_id", "id"]),
    "classifications": ("agregado_id long, id string, nome string", ["agregado_id", "id"]),
    "categories": ("agregado_id long, classification_id string, id string, nome string, unidade string, nivel long", ["agregado_id", "classification_id", "id"]),
    "periods": ("agregado_id long, periodo_id string, nome string, periodo_ord long, periodo_kind string", ["agregado_id", "periodo_id"]),
    "localities": ("agregado_id long, level_id string, locality_id string, nome string", ["agregado_id", "level_id", "locality_id"]),
    "name_keys": ("kind string, name_key string, nome string", ["kind", "name_key"]),
    "link_var": ("name_key string, agregado_id long, variable_id string", ["name_key", "agregado_id", "variable_id"]),
    "link_class": ("name_key string, agregado_id long, classification_id string", ["name_key", "agregado_id", "classification_id"]),
    "link_cat": ("class_key string, name_key string, agregado_id long, category_id string", ["class_key", "name_key", "agregado_id", "category_id"]),
    "ingestion_log": ("agregado_id long, stage string, status string, at string", ["agregado_id", "stage", "at"]),
    "raw_value_cache": ("cache_key string, payload string, at string", ["cache_key"]),
}
