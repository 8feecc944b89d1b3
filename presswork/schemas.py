"""Fixed schemas of the stage tables. Nothing is inferred."""

ARTICLE = """
    head struct<
        title: string,
        meta: array<struct<_content: string, _name: string>>,
        docdata: struct<
            `doc-id`: array<struct<`_id-string`: string>>,
            `identified-content`: struct<
                location: array<struct<_VALUE: string, _class: string>>,
                person: array<struct<_VALUE: string, _class: string>>,
                classifier: array<struct<_VALUE: string, _class: string, _type: string>>>>,
        pubdata: struct<`_date.publication`: string, `_item-length`: string, `_ex-ref`: string>>,
    body struct<`body.content`: struct<block: array<struct<_class: string, p: array<string>>>>>
"""

DOCS = "doc_id string, categories array<string>, full_text string"
CATEGORIES = "category string, n bigint, selected boolean, category_idx int"
BAG = "doc_id string, term string, tf bigint, doc_len bigint"
VOCABULARY = "term string, df bigint, cf bigint, term_idx int"
TFIDF = "doc_id string, fold int, term_idx int, weight double"
LABELS = "doc_id string, fold int, categories array<string>"
PREDICTIONS = (
    "model string, doc_id string, category_idx int, label double, score double, prediction double"
)
REPORT = "model string, category_idx int, precision double, recall double, f1 double, support bigint"
