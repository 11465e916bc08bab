"""Values that have to equal the established catalogue format.

Everything here is a fixed value: word lists, patterns, thresholds, column
headers and output keys that results and files depend on.  No logic.
"""

# --- catalogue layout -----------------------------------------------------
PAGE_SIZE = 10
CHUNK_PAGES = 25
CHUNK_FAILURE_CUT = 8
RUN_FAILURE_CUT = 10

# category name -> code of the catalogue
CATEGORIES = {
    "Civil": 1,
    "Comercial": 2,
    "Contencioso Administrativo": 3,
    "Familia Civil": 4,
    "Familia Tutelar": 5,
    "Familia Penal": 6,
    "Contencioso Adm. Laboral": 7,
    "Contencioso Adm. Previsional": 8,
    "Laboral": 9,
    "Penal": 10,
    "Revision de Procedimiento Coactivo": 11,
    "Constitucional": 12,
}

# header of the record table, in file order -> column name used here
RECORD_HEADERS = {
    "Casacion/Apelacion": "case_type",
    "Nro Expediente": "case_no",
    "Pretension/Delito": "subject",
    "Tipo de Resolucion": "ruling_type",
    "Fecha de Resolucion": "ruling_date_raw",
    "Sala Suprema": "court",
    "Norma de Derecho Interno (Articulo)": "rule",
    "Sumilla": "summary",
    "Palabras Clave": "keywords",
    "Link Resolucion": "link",
    "Especialidad": "category",
    "Pagina": "page",
}
# extra keys carried by harvested rows
HARVEST_HEADERS = {"uuid": "record_id", "Origen": "provenance", "uuid_ficha": "sheet_id"}

# keys of a chunk file -> field name used here
CHUNK_HEADERS = {
    "completo": "complete",
    "fallidas": "failed",
    "incompletas": "short",
    "filas": "rows",
}

# columns of the official export, by position (its header is unreadable)
EXPORT_COLUMNS = [
    "_empty",
    "case_key",
    "subject",
    "ruling_type",
    "ruling_date_raw",
    "court",
    "rule",
    "summary",
    "keywords",
    "thesaurus",
]
EXPORT_HELPERS = ["_empty", "thesaurus"]

# manifest column here -> header of the manifest file
MANIFEST_HEADERS = {
    "record_id": "uuid",
    "url": "url",
    "path": "ruta",
    "path_md": "ruta_md",
    "case_no": "Nro Expediente",
    "ruling_date": "Fecha",
    "year": "Anio",
    "category": "Especialidad",
    "id_repeated": "uuid_repetido",
}

# --- text -----------------------------------------------------------------
ID_IN_LINK = r"uuid=([0-9a-fA-F-]{36})"
ID_IN_DOWNLOAD_LINK = r"ServletDescarga\?uuid=([0-9a-fA-F-]{36})"
ID_FORMAT = r"[0-9a-f-]{36}"
PATH_FORMAT = r"[a-z0-9-]+/(?:[0-9]{4}|sin-anio)/[a-z0-9-]+\.pdf"
SUMMARY_LABEL = "sumilla"
LABEL_PUNCTUATION = ".:–—-"
SUMMARY_MIN_CHARS = 20
ID_CHARS_IN_PATH = 8
NO_CATEGORY = "sin-especialidad"
NO_YEAR = "sin-anio"
NO_CASE_TYPE = "resolucion"

# --- listing pages --------------------------------------------------------
PANEL_ID = r"formBuscador:repeat:\d+:j_idt\d+"
PANEL_COUNT = r'id="formBuscador:repeat:\d+:j_idt\d+"\s+style="width:100%'
LISTING_TOTALS = (
    r"De un total de\s*([\d.,]+)\s*resoluciones,\s*"
    r"se obtuvieron\s*([\d.,]+)\s*resultados"
)
# key inside the panel's "parameters" object -> column
PAYLOAD_FIELDS = {
    "recurso": "case_type",
    "nroexp": "case_no",
    "pretensiones": "subject",
    "tipoResolucion": "ruling_type",
    "fechaResolucion": "ruling_date_raw",
    "sala": "court",
    "normaDI": "rule",
    "sumilla": "summary",
    "palabras": "keywords",
}
# visible label, folded -> column
PANEL_LABELS = {
    "pretension/delito": "subject",
    "tipo resolucion": "ruling_type",
    "fecha resolucion": "ruling_date_raw",
    "sala suprema": "court",
    "norma de derecho interno": "rule",
    "sumilla": "summary",
    "palabras clave": "keywords",
}
FROM_PAYLOAD = "json"
FROM_LABELS = "html"
FROM_LABELS_MISMATCH = "html-descuadre"
FROM_EXTERNAL = "excel"

# --- document text --------------------------------------------------------
# a block holding any of these is a notification stamp
STAMP = (
    r"SINOE|Sistema de Notificaciones|FIRMA DIGITAL|Servicio Digital"
    r"|Vocal Supremo\s*:|Secretari[oa]\s*:|D\.?Judicial\s*:"
    r"|Razón\s*:\s*RESOLUCI[OÓ]N|SEDE PALACIO DE JUSTICIA"
)
# a line that is only this is letterhead or a page number
LETTERHEAD = (
    r"^\s*(CORTE SUPREMA DE JUSTICIA( DE LA REPÚBLICA)?"
    r"|PODER JUDICIAL DEL PERÚ|-?\s*\d+\s*-?)\s*$"
)
# whole-line section headers, first match wins
SECTION_HEADERS = [
    (r"VIST[OA]S?\b.*", "Vistos"),
    (r"(I+\.?\s*)?ASUNTO\b", "Asunto"),
    (r"(I+\.?\s*)?MATERIA DEL RECURSO\b", "Materia del recurso"),
    (r"(I+\.?\s*)?MATERIA DE LA CONSULTA\b", "Materia de la consulta"),
    (r"(I+\.?\s*)?ANTECEDENTES\b", "Antecedentes"),
    (r"CAUSAL(ES)? (DEL|DE LOS) RECURSO?S?\b", "Causales del recurso"),
    (r"(I+\.?\s*)?FUNDAMENTOS?( DEL RECURSO| DE LA SALA)?\b", "Fundamentos"),
    (r"CONSIDERANDO\b", "Considerando"),
    (r"(I+\.?\s*)?AN[ÁA]LISIS\b", "Análisis"),
    (r"(I+\.?\s*)?DECISI[ÓO]N\b", "Decisión"),
    (r"AUTO CALIFICATORIO DEL RECURSO\b", "Auto calificatorio"),
    (r"S\.?\s*S\.?", "Firmas"),
]
# openers at the start of a line that goes on
SECTION_OPENERS = [
    (r"POR (ESTOS|ESTAS) (FUNDAMENTOS|CONSIDERACIONES|RAZONES)", "Decisión"),
    (r"(SE RESUELVE|HA RESUELTO|RESUELVE|RESOLVIERON|DECLARARON|FALLO)\b", "Decisión"),
]
MIN_TEXT_CHARS = 200
REASON_NO_TEXT = "sin texto"
REASON_SCANNED = "escaneado"
# key of the markdown front matter -> column it is filled from
FRONT_MATTER = {
    "uuid": "record_id",
    "expediente": "case_no",
    "recurso": "case_type",
    "especialidad": "category",
    "sala": "court",
    "fecha": "ruling_date_raw",
    "anio": "year",
    "materia": "subject",
    "norma": "rule",
    "palabras_clave": "keywords",
    "url": "link",
    "paginas": "n_pages",
    "caracteres": "n_chars",
    "secciones": "section_list",
}

# --- stored files ---------------------------------------------------------
PDF_HEAD = "%PDF-"
PDF_MIN_BYTES = 1000
IMAGE_FILTERS = ["/DCTDecode", "/CCITTFaxDecode", "/JBIG2Decode", "/JPXDecode"]
FONT_MARK = "/Font"
CLASS_SCANNED = "escaneado"
CLASS_NATIVE = "nativo"
CLASS_MIXED = "mixto"
CLASS_UNKNOWN = "?"

# --- lots -----------------------------------------------------------------
MODERN_FROM_YEAR = 2017
MODERN_KB = 307
OLD_KB = 2194
FILES_PER_HOUR = 660
SPACE_FACTOR = 1.3
DONE_SHARE = 0.99
RATE_INTERVAL_SECONDS = 90
