"""Fixed value lists and rules of the data-dictionary template (scope documents, landing
layer). These values must equal the template's; they are stated here as text."""

from __future__ import annotations

# ---- Fixed values (template "values" sheet) -------------------------------------------
DOMAINS = [
    "Atenciones Médicas", "Canales de Venta", "Cliente Cuenta Persona Jurídica",
    "Cliente Cuenta Persona Natural", "Cobranzas", "Data & Analytics",
    "Empresas Prestadoras", "Finanzas", "Médicos", "Póliza", "Producto Empresa",
    "Producto Persona", "Siniestros",
]
COMPANIES = ["demo", "corp"]
LANDING_SCHEMAS = {
    "dataentry_int": "transitorio (ingesta interna)",
    "dataentry_ext": "información externa",
    "dataentry_usr": "permanente (usuario)",
}
SOURCE_KINDS = ["DESCRIPTIVA", "MAESTRA", "HISTORICA", "DATA ENTRY"]
LOAD_KINDS = ["Full", "Incremental"]
FREQUENCIES = [
    "DIARIA (L - V) Feriados", "DIARIA (L - V) Sin Feriados",
    "DIARIA (L - D) Feriados", "DIARIA (L - D) Sin Feriados",
    "SEMANAL", "MENSUAL", "A DEMANDA",
]
CLASSIFICATIONS = {"publico": "public", "uso interno": "internal", "restringido": "restricted"}
CRITICALITIES = ["EDC", "EDNC"]
REQUIRED_LAYER = "LANDING"
SUPPORTED_TEMPLATE_VERSIONS = ["3"]

# Landing format (normalised, blanks as "_") → (logical type, physical type).
# DECIMAL's physical type comes from the landing length "p,s".
TYPE_MAP = [
    ("string", "string", "STRING"),
    ("varchar", "string", "STRING"),
    ("char", "string", "STRING"),
    ("decimal", "number", None),
    ("date", "date", "DATE"),
    ("time_stamp", "timestamp", "TIMESTAMP"),
    ("timestamp", "timestamp", "TIMESTAMP"),
    ("boolean", "boolean", "BOOLEAN"),
    ("bit", "boolean", "BOOLEAN"),
    ("time", "string", "STRING"),
]

# The two patterns of the template.
IDENTIFIER = r"^[a-z][a-z0-9_]*$"
DECIMAL_LENGTH = r"^\s*(\d+)\s*[,.;]\s*(\d+)\s*$"

# Tags of a table and of anything sensitive, and the rule every table carries.
TABLE_TAG, SENSITIVE_TAG = "dataentry", "dac"
NOT_EMPTY_RULE = "tabla_no_vacia"

# Cells that must be filled.
TABLE_MANDATORY = [
    "dominio", "capa", "empresa", "schema_landing", "tabla_fuente", "tabla_landing",
    "descripcion", "tipo_fuente", "tipo_carga", "frecuencia",
]
FIELD_MANDATORY = [
    "nombre_fuente", "nombre_modelado", "formato_landing", "definicion", "descartado",
    "pk", "dac", "nulos", "clasificacion",
]
# yes/no cells of a field row.
FIELD_FLAGS = ["descartado", "pk", "dac", "nulos", "vacios", "llave_tecnica", "trazabilidad"]
# Table cells checked against a list: (cell, allowed values).
TABLE_LISTS = [
    ("dominio", DOMAINS),
    ("empresa", COMPANIES),
    ("schema_landing", list(LANDING_SCHEMAS)),
    ("tipo_fuente", SOURCE_KINDS),
    ("tipo_carga", LOAD_KINDS),
    ("frecuencia", FREQUENCIES),
]
# Field cells that become column custom properties, in output order: (property, cell).
# ``campoTecnico`` has no cell: it is "true" when the source cell names a technical field.
FIELD_ATTRIBUTES = [
    ("fuente", "fuente"), ("campoTecnico", None), ("dac", "dac"), ("contieneVacios", "vacios"),
    ("criticidad", "criticidad"), ("sustentoCriticidad", "sustento_criticidad"),
    ("tipoFormatoGobierno", "tipo_formato"), ("formatoInput", "formato_input"),
    ("longitudFuente", "longitud_fuente"), ("aplicaTrazabilidad", "trazabilidad"),
    ("llaveTecnica", "llave_tecnica"),
]
TECHNICAL_SOURCE = "(campo tecnico)"

# The cells of a table row and of a field row.
TABLE_CELLS = [
    "ruta_broad", "contenedor_broad", "dominio", "capa", "empresa", "schema_landing",
    "tabla_fuente", "tabla_landing", "registros", "historia", "ruta_landing", "descripcion",
    "tipo_fuente", "tipo_carga", "frecuencia", "dac", "product_owner", "squad",
]
FIELD_CELLS = [
    "id", "fuente", "trazabilidad", "nombre_fuente", "nombre_modelado", "tipo_formato",
    "formato_input", "formato_landing", "definicion", "longitud_fuente", "longitud_landing",
    "ejemplos", "catalogo", "descartado", "pk", "llave_tecnica", "dac", "vacios", "nulos",
    "criticidad", "sustento_criticidad", "clasificacion",
]

# Table-level custom properties of a produced contract, in output order:
# (property, source) where source is a table cell, or one of the derived values
# "=LANDING", "=DED" (constants), "schema_kind", "any_dac", "discarded_names".
TABLE_PROPERTIES = [
    ("capa", "=LANDING"), ("flujo", "=DED"), ("empresa", "empresa"), ("schemaLanding", "schema_landing"),
    ("tipoDataEntry", "schema_kind"), ("nombreTablaFuente", "tabla_fuente"), ("tipoFuente", "tipo_fuente"),
    ("tipoCarga", "tipo_carga"), ("frecuenciaActualizacion", "frecuencia"), ("historia", "historia"),
    ("registrosCargaInicial", "registros"), ("rutaBroad", "ruta_broad"),
    ("contenedorBroad", "contenedor_broad"), ("rutaLanding", "ruta_landing"), ("dac", "any_dac"),
    ("productOwner", "product_owner"), ("squad", "squad"), ("camposDescartados", "discarded_names"),
    ("documentoAlcance", "document"), ("versionPlantillaDED", "template_version"),
]
