"""Declared schemas; nothing is inferred."""

from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


COMMENT = _struct(
    id=_S, body=_S, author=_S, author_flair_text=_S, author_flair_css_class=_S, subreddit=_S, created_utc=_L, score=_L, controversiality=_L, parent_id=_S, link_id=_S
)
POST = _struct(id=_S, title=_S, link_flair_text=_S, author_flair_text=_S, score=_L, num_comments=_L, created_utc=_L)
MENTION = T.StructType([*COMMENT.fields, T.StructField("mentioned_entities", T.ArrayType(_S))])
REQUEST = _struct(
    custom_id=_S, params=_struct(model=_S, max_tokens=T.IntegerType(), temperature=_D, messages=T.ArrayType(_struct(role=_S, content=_S)))
)
RESULT = _struct(custom_id=_S, result_type=_S, content=_S, input_tokens=_L, output_tokens=_L, error=_S)
LABEL = _struct(id=_S, sentiment=_S, confidence=_D, label_entity=_S, input_tokens=_L, output_tokens=_L)
SENTIMENT = _struct(
    comment_id=_S, body=_S, author=_S, author_flair_text=_S, author_flair_css_class=_S, created_utc=_L, score=_L, mentioned_entities=T.ArrayType(_S), sentiment=_S, confidence=_D, label_entity=_S, input_tokens=_L, output_tokens=_L
)
ENTITY_DIM = _struct(name=_S, team=_S, conference=_S, entity_id=_L, image=_S)
TEAM_DIM = _struct(name=_S, abbreviation=_S, conference=_S, team_id=_L, logo=_S)
ALIAS_DIM = _struct(alias=_S, name=_S, ordinal=T.IntegerType(), bounded=T.BooleanType())
