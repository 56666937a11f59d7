"""Table schemas and the nested article schema."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
TS = T.TimestampType()
FLOATS = T.ArrayType(T.FloatType())


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def listed(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(kind, True)


CHUNK_LOG = struct(
    namespace=S, chunk_name=S, chunk_archive_path=S, chunk_extracted_path=S,
    downloaded_at=TS, unpacked_at=TS,
)
PAGE_LOG = struct(
    namespace=S, page_id=L, title=S, chunk_name=S, url=S, extracted_at=TS, abstract=S,
)
PAGE_VECTOR = struct(
    namespace=S, page_id=L, embedding_vector=FLOATS, reduced_vector=FLOATS,
    cluster_id=L, cluster_node_id=L, three_d_vector=FLOATS,
)
CLUSTER_TREE = struct(
    namespace=S, node_id=L, parent_id=L, depth=T.ShortType(), centroid=FLOATS,
    doc_count=T.IntegerType(), top_terms=listed(S), sample_doc_ids=listed(L),
    child_count=T.IntegerType(), first_label=S, final_label=S,
)

PAGE_KEY = ["namespace", "page_id"]
CHUNK_KEY = ["namespace", "chunk_name"]
NODE_KEY = ["namespace", "node_id"]

# The five keys a page line is read for, plus the older name of the first.
PAGE_LINE = struct(identifier=L, id=L, name=S, url=S, abstract=S)

# ---- nested article records; key case differs between record types in the feed ----
SIZE = struct(value=D, unit_text=S)
NAMED_LINK = struct(name=S, url=S)
ENTITY = struct(identifier=S, url=S, aspects=listed(S))
LANGUAGE = struct(identifier=S, name=S, alternate_name=S, direction=S)
NAMESPACE = struct(name=S, identifier=L, description=S)
CODE = struct(identifier=S, name=S, description=S)
LICENSE = struct(name=S, identifier=S, url=S)
PROTECTION = struct(type=S, level=S, expiry=S)
VISIBILITY = struct(text=B, editor=B, comment=B)
ARTICLE_BODY = struct(html=S, wikitext=S)
IMAGE = struct(contentUrl=S, width=L, height=L, alternativeText=S, caption=S)
EDITOR = struct(
    identifier=L, name=S, editCount=L, groups=listed(S), isBot=B, isAnonymous=B, isAdmin=B,
    isPatroller=B, hasAdvancedRights=B, dateStarted=TS,
)
SCORES = struct(
    revert_risk=struct(prediction=B, probability=T.StructType(
        [T.StructField("false", D, True), T.StructField("true", D, True)]
    ))
)
VERSION = struct(
    identifier=L, comment=S, tags=listed(S), is_minor_edit=B, is_flagged_stable=B,
    is_breaking_news=B, has_tag_needs_citation=B, scores=SCORES, editor=EDITOR,
    number_of_characters=L, size=SIZE,
)
PREVIOUS_VERSION = struct(identifier=L, number_of_characters=L)
EVENT = struct(
    identifier=S, eventType=S, dateCreated=TS, datePublished=TS, partition=L, offset=L,
)
PROJECT = struct(
    name=S, identifier=S, url=S, code=S, version=S, dateModified=TS, inLanguage=LANGUAGE, size=SIZE,
)
ARTICLE = struct(
    name=S, abstract=S, identifier=L, date_created=TS, date_modified=TS,
    date_previously_modified=TS, protection=listed(PROTECTION), version=VERSION,
    previous_version=PREVIOUS_VERSION, url=S, watchers_count=L, namespace=NAMESPACE,
    in_language=LANGUAGE, main_entity=ENTITY, additional_entities=listed(ENTITY),
    categories=listed(NAMED_LINK), templates=listed(NAMED_LINK), redirects=listed(NAMED_LINK),
    is_part_of=PROJECT, article_body=ARTICLE_BODY, license=listed(LICENSE),
    visibility=VISIBILITY, event=EVENT, image=IMAGE,
)

# ---- catalogue listings ----
SNAPSHOT = struct(
    identifier=S, version=S, date_modified=TS, is_part_of=PROJECT, in_language=LANGUAGE,
    namespace=NAMESPACE, size=SIZE, chunks=listed(S),
)
BATCH = struct(
    identifier=S, version=S, dateModified=TS, isPartOf=PROJECT, inLanguage=LANGUAGE,
    namespace=NAMESPACE, size=SIZE,
)
CHUNK = struct(
    identifier=S, version=S, date_modified=TS, is_part_of=PROJECT, in_language=LANGUAGE,
    namespace=NAMESPACE, size=SIZE,
)
CATALOGUE = {
    "codes": CODE, "languages": LANGUAGE, "projects": PROJECT, "namespaces": NAMESPACE,
    "snapshots": SNAPSHOT, "structured_snapshots": SNAPSHOT, "chunks": CHUNK, "batches": BATCH,
}

# ---- structured contents: the recursive members stay VARIANT ----
LINK = struct(url=S, text=S, images=listed(IMAGE))
CITATION = struct(identifier=S, group=S, text=S)
REFERENCE_TEXT = struct(value=S, links=listed(LINK))
VARIANTS = listed(T.VariantType())
REFERENCE = struct(
    identifier=S, group=S, type=S, metadata=T.MapType(S, S), text=REFERENCE_TEXT,
    source=REFERENCE_TEXT,
)
STRUCTURED_CONTENT = struct(
    name=S, identifier=L, abstract=S, description=S, version=VERSION, url=S, dateCreated=TS, dateModified=TS,
    mainEntity=ENTITY, additionalEntities=listed(ENTITY), isPartOf=PROJECT, inLanguage=LANGUAGE, infoboxes=VARIANTS,
    articleSections=VARIANTS, tables=VARIANTS, references=listed(REFERENCE), image=IMAGE,
)
