"""Declared schemas, keys and constraints of the source and warehouse tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

INT, LONG, SHORT = T.IntegerType(), T.LongType(), T.ShortType()
TEXT, DATE, TS, BOOL = T.StringType(), T.DateType(), T.TimestampType(), T.BooleanType()

# Fixed values of the model.
EMAIL_PATTERN = r"^[A-Z0-9._%-]+@[A-Z0-9.-]+\.[A-Z]{2,4}$"
ROLES = ("estudiante", "docente")
VISIBILITIES = ("publico", "interno", "privado")
EMBEDDING_DIMS = 384
PUBLICATION, VIEW, FAVOURITE = 1, 2, 3
INTERACTION_TYPES = ((PUBLICATION, "publicacion"), (VIEW, "visualizacion"), (FAVOURITE, "favorito_agregar"))
EPOCH = "1970-01-01 00:00:00"


def struct(*columns: tuple) -> T.StructType:
    """``(name, type)`` is required, ``(name, type, True)`` may be null."""
    return T.StructType([T.StructField(c[0], c[1], len(c) > 2 and c[2]) for c in columns])


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)
    domains: dict[str, tuple] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)
    minimum: dict[str, int] = field(default_factory=dict)
    pattern: dict[str, str] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()
    partition_by: tuple[str, ...] = ()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def columns(self) -> list[str]:
        return self.schema.names


STAMPS = (("created_at", TS), ("updated_at", TS))

SOURCE_TABLES = {
    c.name: c
    for c in (
        Contract("escuela", struct(("id", INT), ("nombre", TEXT), *STAMPS), ("id",), max_length={"nombre": 200}),
        Contract(
            "carrera",
            struct(("id", INT), ("id_escuela", INT), ("nombre", TEXT), *STAMPS),
            ("id",),
            foreign={"id_escuela": ("escuela", "id")},
            max_length={"nombre": 200},
        ),
        Contract(
            "materia",
            struct(("id", INT), ("id_carrera", INT), ("nombre", TEXT), *STAMPS),
            ("id",),
            foreign={"id_carrera": ("carrera", "id")},
            max_length={"nombre": 200},
        ),
        Contract(
            "usuario",
            struct(("id", INT), ("email", TEXT), ("nombre", TEXT), ("rol", TEXT), ("id_carrera", INT, True), *STAMPS),
            ("id",),
            foreign={"id_carrera": ("carrera", "id")},
            domains={"rol": ROLES},
            max_length={"email": 255, "nombre": 200},
            pattern={"email": EMAIL_PATTERN},
            unique=(("email",),),
        ),
        Contract("tipo_documento", struct(("id", INT), ("nombre", TEXT)), ("id",), unique=(("nombre",),), max_length={"nombre": 50}),
        Contract(
            "documento",
            struct(
                ("id", INT), ("titulo", TEXT), ("abstract", TEXT, True), ("texto_completo", TEXT, True),
                ("visibilidad", TEXT), ("id_tipo", INT), ("id_materia", INT), ("id_uploader", INT),
                ("archivo_url", TEXT, True), ("embedding", T.ArrayType(T.FloatType()), True),
                ("texto_busqueda", T.ArrayType(TEXT), True), ("deleted_at", TS, True), *STAMPS,
            ),
            ("id",),
            foreign={"id_tipo": ("tipo_documento", "id"), "id_materia": ("materia", "id"), "id_uploader": ("usuario", "id")},
            domains={"visibilidad": VISIBILITIES},
            max_length={"titulo": 500},
        ),
        Contract(
            "documento_autor",
            struct(("id_documento", INT), ("id_usuario", INT), ("orden", SHORT)),
            ("id_documento", "id_usuario"),
            foreign={"id_documento": ("documento", "id"), "id_usuario": ("usuario", "id")},
            minimum={"orden": 1},
        ),
        Contract(
            "favorito",
            struct(("id_usuario", INT), ("id_documento", INT), ("created_at", TS)),
            ("id_usuario", "id_documento"),
            foreign={"id_documento": ("documento", "id"), "id_usuario": ("usuario", "id")},
        ),
        Contract(
            "evento_visualizacion",
            struct(("id", LONG), ("id_usuario", INT, True), ("id_documento", INT), ("created_at", TS)),
            ("id",),
            foreign={"id_documento": ("documento", "id"), "id_usuario": ("usuario", "id")},
        ),
        Contract(
            "descarga",
            struct(("id", LONG), ("id_usuario", INT, True), ("id_documento", INT), ("created_at", TS)),
            ("id",),
            foreign={"id_documento": ("documento", "id"), "id_usuario": ("usuario", "id")},
        ),
        Contract(
            "comentario",
            struct(
                ("id", LONG), ("id_usuario", INT), ("id_documento", INT), ("id_comentario_padre", LONG, True),
                ("texto", TEXT), ("esta_oculto", BOOL), ("fecha_oculto", TS, True), *STAMPS,
            ),
            ("id",),
            foreign={"id_documento": ("documento", "id"), "id_comentario_padre": ("comentario", "id")},
            max_length={"texto": 2000},
        ),
        Contract(
            "busqueda",
            struct(
                ("id", LONG), ("id_usuario", INT, True), ("query_texto", TEXT), ("id_escuela_filtro", INT, True),
                ("id_carrera_filtro", INT, True), ("id_materia_filtro", INT, True), ("id_tipo_documento_filtro", INT, True),
                ("fecha_desde_filtro", DATE, True), ("fecha_hasta_filtro", DATE, True), ("cant_resultados", INT),
                ("hizo_click", BOOL), ("session_hash", TEXT, True), ("created_at", TS),
            ),
            ("id",),
            max_length={"query_texto": 255, "session_hash": 64},
        ),
    )
}

WAREHOUSE_TABLES = {
    c.name: c
    for c in (
        Contract(
            "dim_materia",
            struct(
                ("id_materia", INT), ("nombre_materia", TEXT), ("id_carrera", INT), ("nombre_carrera", TEXT),
                ("id_escuela", INT), ("nombre_escuela", TEXT),
            ),
            ("id_materia",),
        ),
        Contract(
            "dim_tiempo",
            struct(("fecha", DATE), ("dia", SHORT), ("mes", SHORT), ("cuatrimestre", SHORT), ("anio", SHORT)),
            ("fecha",),
        ),
        Contract(
            "dim_usuario",
            struct(
                ("id_usuario", INT), ("id_carrera", INT), ("nombre_carrera", TEXT), ("nombre_escuela", TEXT),
                ("nombre", TEXT, True),
            ),
            ("id_usuario",),
        ),
        Contract("dim_tipo_documento", struct(("id_tipo", INT), ("nombre", TEXT)), ("id_tipo",)),
        Contract(
            "dim_documento",
            struct(
                ("id_documento", INT), ("id_tipo", INT), ("id_materia", INT), ("titulo", TEXT), ("fecha_alta", DATE),
                ("visibilidad", TEXT), ("is_deleted", BOOL), ("deleted_at", DATE, True),
            ),
            ("id_documento",),
            foreign={"id_tipo": ("dim_tipo_documento", "id_tipo"), "id_materia": ("dim_materia", "id_materia")},
        ),
        Contract("dim_tipo_interaccion", struct(("id_tipo_interaccion", INT), ("nombre", TEXT)), ("id_tipo_interaccion",)),
        Contract(
            "fact_interaccion_documento",
            struct(("fecha", DATE), ("id_documento", INT), ("id_tipo_interaccion", INT), ("cant_interacciones", INT)),
            ("fecha", "id_documento", "id_tipo_interaccion"),
            foreign={
                "fecha": ("dim_tiempo", "fecha"),
                "id_documento": ("dim_documento", "id_documento"),
                "id_tipo_interaccion": ("dim_tipo_interaccion", "id_tipo_interaccion"),
            },
            partition_by=("mes_fecha",),
        ),
        Contract(
            "fact_interaccion_autor",
            struct(("fecha", DATE), ("id_usuario", INT), ("id_tipo_interaccion", INT), ("cant_interacciones", INT)),
            ("fecha", "id_usuario", "id_tipo_interaccion"),
            foreign={
                "fecha": ("dim_tiempo", "fecha"),
                "id_usuario": ("dim_usuario", "id_usuario"),
                "id_tipo_interaccion": ("dim_tipo_interaccion", "id_tipo_interaccion"),
            },
            partition_by=("mes_fecha",),
        ),
        Contract(
            "fact_query_popularity",
            struct(("fecha", DATE), ("query_texto", TEXT), ("score", INT), ("ranking", SHORT)),
            ("fecha", "query_texto"),
            foreign={"fecha": ("dim_tiempo", "fecha")},
            partition_by=("fecha",),
        ),
        Contract(
            "etl_watermark",
            struct(("tabla_origen", TEXT), ("ultimo_procesado", TS), ("ultima_corrida", TS)),
            ("tabla_origen",),
        ),
    )
}


class SchemaMismatch(ValueError):
    """A frame lacks a declared column or carries it with another type."""


def _family(data_type: T.DataType) -> str:
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "floating"
    if isinstance(data_type, T.ArrayType):
        return f"array<{_family(data_type.elementType)}>"
    return data_type.simpleString()


def check_schema(df: DataFrame, contract: Contract) -> DataFrame:
    """Return the declared columns in order; raise if one is missing or of another kind.

    Integer widths are interchangeable because keys may be wider in the field.
    """
    have = {f.name: f.dataType for f in df.schema}
    wrong = [
        f"{f.name}: wanted {f.dataType.simpleString()}, found {have[f.name].simpleString() if f.name in have else 'nothing'}"
        for f in contract.schema
        if f.name not in have or _family(have[f.name]) != _family(f.dataType)
    ]
    if wrong:
        raise SchemaMismatch(f"{contract.name}: " + "; ".join(wrong))
    return df.select(*contract.columns)


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Cast to the declared types; ANSI casts raise on overflow, as the warehouse should."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in contract.schema])
