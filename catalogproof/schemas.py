"""Explicit schemas of every table the library reads or writes."""

from pyspark.sql import types as T

from catalogproof import fixed_values as fx

_S = T.StringType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


#: the twelve columns of a catalogue record, in file order
RECORD_COLUMNS = list(fx.RECORD_HEADERS.values())

#: columns that say "the same ruling": everything but the link and the page
CONTENT_COLUMNS = [c for c in RECORD_COLUMNS if c not in ("link", "page")]

#: free text, cleaned for spacing only
TEXT_COLUMNS = ["subject", "rule", "summary", "keywords"]

#: columns whose spellings are unified
CATEGORY_COLUMNS = ["case_type", "ruling_type", "court", "category"]

RECORD = T.StructType(
    [
        T.StructField(c, T.IntegerType() if c == "page" else _S, True)
        for c in ["record_id", *RECORD_COLUMNS, "provenance"]
    ]
    + [T.StructField("row_id", T.LongType(), True)]
)

#: derived columns that follow the original ones in a cleaned table
CLEAN_COLUMNS = [
    "record_id",
    "ruling_date",
    "year",
    "case_year",
    "summary_had_prefix",
    "summary_useful",
    "date_incoherent",
    "id_repeated",
    "pdf_path",
    "md_path",
    "dup_group",
    "is_content_dup",
    "is_droppable_copy",
]

MANIFEST = _struct(
    record_id=_S,
    url=_S,
    path=_S,
    path_md=_S,
    case_no=_S,
    ruling_date=T.DateType(),
    year=T.IntegerType(),
    category=_S,
    id_repeated=T.BooleanType(),
)

#: a record as it stands inside a chunk file, under its file headers
CHUNK_ROW = T.StructType(
    [
        T.StructField(header, T.IntegerType() if name == "page" else _S, True)
        for header, name in {**fx.HARVEST_HEADERS, **fx.RECORD_HEADERS}.items()
    ]
)

CHUNK_FILE = _struct(
    categoria=_S,
    tramo=T.IntegerType(),
    parte=T.IntegerType(),
    completo=T.BooleanType(),
    fallidas=T.ArrayType(T.IntegerType()),
    incompletas=T.ArrayType(T.IntegerType()),
    filas=T.ArrayType(CHUNK_ROW),
    _corrupt=_S,
)

LOT_STATE = _struct(
    year=T.IntegerType(),
    documents=T.LongType(),
    pdfs=T.LongType(),
    markdown=T.LongType(),
    bytes_pdf=T.LongType(),
    bytes_md=T.LongType(),
    processed_at=T.TimestampType(),
    uploaded_at=T.TimestampType(),
    pending_ocr=T.LongType(),
)

PDF_SAMPLE = _struct(
    year=T.IntegerType(),
    bytes=T.LongType(),
    kind=_S,
    n_pages=T.IntegerType(),
    category=_S,
)
