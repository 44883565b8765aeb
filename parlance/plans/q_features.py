"""Registered queries: batches, token features, intent classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.config import DEFAULT, scratch_path
from parlance.operators import bayes
from parlance.operators import classifier as clf
from parlance.operators import features as fe
from parlance.operators import splits as sp
from parlance.plans.oracle_sql import VIEWS, with_views
from parlance.plans.q_splits import stored_splits
from parlance.plans.registry import register, rounded
from parlance.sources import views
from parlance.sources.tables import table

V = DEFAULT.vocab_size


def _tok_sql(src: str, text: str, id_col: str = "row_id") -> str:
    return (
        f"SELECT {id_col} AS row_id, generate_subscripts(arr, 1) - 1 AS pos, unnest(arr) AS token "
        f"FROM (SELECT {id_col}, list_filter(regexp_split_to_array({text}, '\\s+'), lambda t: t <> '') AS arr FROM {src}) s"
    )


def _vocab_sql(toks: str) -> str:
    return (
        f"SELECT token, n, CAST(rk + 2 AS INTEGER) AS id FROM (SELECT token, n, row_number() OVER (ORDER BY n DESC, token) AS rk "
        f"FROM (SELECT token, count(*) AS n FROM ({toks}) t GROUP BY token) c) r WHERE rk <= {V - 3}"
    )


def _encode_sql(rows: str, toks: str, vocab: str, n: int) -> str:
    """Ids of every row, end id, cut to n-1 + end when long, padded to n."""
    return f"""
SELECT row_id, array_to_string(list_resize(body, {n}, 0), ' ') AS ids_text, CAST(len(body) AS BIGINT) AS n_real
FROM (SELECT row_id, CASE WHEN len(full_ids) > {n} THEN list_concat(list_slice(full_ids, 1, {n - 1}), [1]) ELSE full_ids END AS body
      FROM (SELECT s.row_id, list_concat(coalesce(ids, []), [1]) AS full_ids
            FROM ({rows}) s LEFT JOIN (
              SELECT t.row_id, list(coalesce(v.id, 2) ORDER BY t.pos) AS ids
              FROM ({toks}) t LEFT JOIN ({vocab}) v ON t.token = v.token GROUP BY t.row_id) i ON s.row_id = i.row_id) a) b
"""


PAIR_TOKS = f"{_tok_sql('pairs', 'input_text')} UNION ALL {_tok_sql('pairs', 'output_text')}"
PAIR_VOCAB = _vocab_sql(PAIR_TOKS)
DOC_TOKS = _tok_sql("documents", "text", "doc_id")
DOC_VOCAB = _vocab_sql(DOC_TOKS)


ROWS = "SELECT row_id FROM pairs"


def _build_pair_vocab(spark, sf_dir):
    p = views.pairs(spark, sf_dir)
    toks = fe.tokens(p, "input_text").unionByName(fe.tokens(p, "output_text"))
    return fe.build_vocabulary(toks)


def _pair_vocab(spark, sf_dir):
    """The stored vocabulary that encoding and decoding read."""
    return views.written(spark, sf_dir, "pair_vocabulary", lambda: _build_pair_vocab(spark, sf_dir))


@register("build_vocabulary", with_views(PAIR_VOCAB, "pairs"))
def q_build_vocabulary(spark, sf_dir):
    """Vocabulary of the training pairs, dense ids from 3."""
    return _build_pair_vocab(spark, sf_dir)


def _encoded(spark, sf_dir, text: str, n: int):
    p = views.pairs(spark, sf_dir)
    ids = fe.encode_tokens(p, text, _pair_vocab(spark, sf_dir), keep=n)
    padded, mask = fe.pad_truncate_ids(F.col("ids"), n)
    return ids.select("row_id", padded.alias("padded"), mask.alias("mask"))


@register(
    "encode_tokens",
    with_views(_encode_sql(ROWS, _tok_sql("pairs", "input_text"), PAIR_VOCAB, DEFAULT.max_input_length), "pairs"),
)
def q_encode_tokens(spark, sf_dir):
    """P23 + P20: input ids of every pair, length 128, and the real-token count."""
    e = _encoded(spark, sf_dir, "input_text", DEFAULT.max_input_length)
    return e.select(
        "row_id", F.array_join("padded", " ").alias("ids_text"), F.size(F.array_remove("mask", 0)).cast("bigint").alias("n_real")
    )


@register(
    "pad_truncate_ids",
    _encode_sql("SELECT doc_id AS row_id FROM documents", DOC_TOKS, DOC_VOCAB, DEFAULT.max_input_length),
)
def q_pad_truncate_ids(spark, sf_dir):
    """P20 on documents: encoded to the first 128 ids or padded to as many."""
    d = table(spark, sf_dir, "documents", "doc_id", "text").withColumnRenamed("doc_id", "row_id")
    vocab = views.written(spark, sf_dir, "document_vocabulary", lambda: fe.build_vocabulary(fe.tokens(d, "text")))
    ids = fe.encode_tokens(d, "text", vocab, keep=DEFAULT.max_input_length)
    padded, mask = fe.pad_truncate_ids(F.col("ids"), DEFAULT.max_input_length)
    return ids.select(
        "row_id",
        F.array_join(padded, " ").alias("ids_text"),
        F.size(F.array_remove(mask, 0)).cast("bigint").alias("n_real"),
    )


_LABELS_SQL = _encode_sql(ROWS, _tok_sql("pairs", "output_text"), PAIR_VOCAB, DEFAULT.max_output_length)


@register(
    "mask_labels",
    with_views(
        f"SELECT row_id, array_to_string(list_transform(string_split(ids_text, ' '), lambda x: CASE WHEN x = '0' THEN '-100' ELSE x END), ' ') "
        f"AS labels_text FROM ({_LABELS_SQL}) e",
        "pairs",
    ),
)
def q_mask_labels(spark, sf_dir):
    """Label ids of every pair with padding as -100."""
    e = _encoded(spark, sf_dir, "output_text", DEFAULT.max_output_length)
    return e.select("row_id", F.array_join(fe.mask_labels(F.col("padded")), " ").alias("labels_text"))


@register(
    "unmask_decode",
    with_views(
        f"SELECT s.row_id, coalesce(text, '') AS text FROM ({ROWS}) s LEFT JOIN (SELECT t.row_id, string_agg(v.token, ' ' ORDER BY t.pos) AS text FROM ("
        f"SELECT row_id, pos, token FROM ({_tok_sql('pairs', 'output_text')}) x WHERE pos < {DEFAULT.max_output_length - 1}) t "
        f"JOIN ({PAIR_VOCAB}) v ON t.token = v.token GROUP BY t.row_id) x ON s.row_id = x.row_id",
        "pairs",
    ),
)
def q_unmask_decode(spark, sf_dir):
    """Labels back to text (special and ignored ids dropped)."""
    e = _encoded(spark, sf_dir, "output_text", DEFAULT.max_output_length)
    masked = e.select("row_id", fe.mask_labels(F.col("padded")).alias("labels"))
    return fe.unmask_decode(masked, "labels", _pair_vocab(spark, sf_dir))


@register(
    "assign_batches",
    with_views(
        "SELECT row_id, split, position, (position - 1) // 16 AS batch FROM ("
        "SELECT row_id, split, row_number() OVER (PARTITION BY split ORDER BY "
        "CASE WHEN split = 'train' THEN md5('42:' || CAST(row_id AS VARCHAR)) END, row_id) AS position FROM splits) s",
        "splits",
    ),
)
def q_assign_batches(spark, sf_dir):
    """Position and batch of 16 in each split (train shuffled by seed)."""
    s = stored_splits(spark, sf_dir).select("row_id", "split")
    return fe.assign_batches(s).select("row_id", "split", "position", "batch")


_EPOCH_NUMBER = "CAST(concat('0x', substr(md5(concat('42:', epoch, ':', {0})), 1, 15)) AS BIGINT)"
_EPOCH_MATE = "(" + _EPOCH_NUMBER.format("r") + " % n - x + n) % n"
_EPOCH_STEP = "CASE WHEN " + _EPOCH_NUMBER.format(f"r, ':', greatest(x, {_EPOCH_MATE})") + f" % 2 = 1 THEN {_EPOCH_MATE} ELSE x END"


@register(
    "epoch_batches",
    with_views(
        f"""SELECT epoch, row_id, spot + 1 AS position, spot // 16 AS batch FROM (
SELECT epoch, row_id, list_reduce(list_prepend(start, range(1, 17)), lambda x, r: {_EPOCH_STEP}) AS spot FROM (
SELECT row_id, row_number() OVER (ORDER BY md5('42:' || CAST(row_id AS VARCHAR)), row_id) - 1 AS start, count(*) OVER () AS n
FROM splits WHERE split = 'train') s, (SELECT unnest([1, 2, 3]) AS epoch) e) p""",
        "splits",
    ),
)
def q_epoch_batches(spark, sf_dir):
    """Position and batch of every training row in each of three epochs."""
    stored = views.written(spark, sf_dir, "batches", lambda: fe.assign_batches(stored_splits(spark, sf_dir).select("row_id", "split")).select("row_id", "split", "position"))
    return fe.epoch_batches(stored, 3)


def _clf_data(spark, sf_dir):
    s = views.written(
        spark, sf_dir, "labelled_splits", lambda: sp.stratified_split(views.labelled_texts(spark, sf_dir)).select("row_id", "text", "intent", "split")
    )
    return s.where("split = 'train'"), s.where("split = 'val'"), s.where("split = 'test'")


@register("train_intent_classifier")
def q_train_intent_classifier(spark, sf_dir):
    """M1: fit on train; the fitted model's predictions on its own train rows."""
    train, _, _ = _clf_data(spark, sf_dir)
    model = clf.train_intent_classifier(train)
    return clf.predict_intents(model, train)


@register("predict_intents")
def q_predict_intents(spark, sf_dir):
    """M2: predictions for the test split as model JSON."""
    train, _, test = _clf_data(spark, sf_dir)
    return clf.predict_intents(clf.train_intent_classifier(train), test)


@register("select_best_model")
def q_select_best_model(spark, sf_dir):
    """M3: candidates with their validation log-loss; the best is flagged."""
    train, val, _ = _clf_data(spark, sf_dir)
    _, table_ = clf.select_best_model(train, val)
    return table_


@register(
    "model_roundtrip",
    "WITH pairs AS (SELECT d.doc_id AS row_id, CASE quality WHEN 1 THEN 'KEEP' ELSE 'DROP' END AS intent "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL), "
    f"split_quotas AS ({VIEWS['split_quotas']}), splits AS ({VIEWS['splits']}) "
    "SELECT row_id, true AS same FROM splits WHERE split = 'test'",
)
def q_model_roundtrip(spark, sf_dir):
    """M4: predictions of the saved-and-loaded model equal the original's."""
    train, _, test = _clf_data(spark, sf_dir)
    model = clf.train_intent_classifier(train)
    again = clf.model_roundtrip(model, scratch_path(spark, "intent_model"))
    a = clf.predict_intents(model, test).select("row_id", F.col("intent_pred").alias("a"))
    b = clf.predict_intents(again, test).select("row_id", F.col("intent_pred").alias("b"))
    return a.join(b, "row_id").select("row_id", (F.col("a") == F.col("b")).alias("same"))


# Documents with their label as intent, split as the labelled texts are; tokens of each.
_LABELLED = (
    "WITH pairs AS (SELECT d.doc_id AS row_id, text, CASE quality WHEN 1 THEN 'KEEP' ELSE 'DROP' END AS intent "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL), "
    f"split_quotas AS ({VIEWS['split_quotas']}), splits AS ({VIEWS['splits']}), "
    "said AS (SELECT row_id, intent, split, unnest(list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), "
    "lambda t: t <> '')) AS token FROM splits), "
    "counts AS (SELECT intent, token, count(*) AS n FROM said WHERE split = 'train' GROUP BY intent, token), "
    "vocab AS (SELECT DISTINCT token FROM counts), "
    "classes AS (SELECT intent, docs, total, (SELECT count(*) FROM vocab) AS v, sum(docs) OVER () AS all_docs FROM "
    "(SELECT intent, count(*) AS docs FROM splits WHERE split = 'train' GROUP BY intent) d "
    "JOIN (SELECT intent, sum(n) AS total FROM counts GROUP BY intent) t USING (intent)) "
)


def _scores_sql(split: str, alphas: str) -> str:
    """(alpha, row_id, truth, intent, score): every row of a split against every class, all known tokens walked."""
    return (
        "SELECT a.alpha, s.row_id, s.intent AS truth, c.intent, "
        "CAST(round(1e9 * ln(CAST(c.docs AS DOUBLE) / c.all_docs)) AS BIGINT) + coalesce((w.score), 0) AS score "
        f"FROM splits s CROSS JOIN classes c CROSS JOIN (SELECT unnest({alphas}) AS alpha) a LEFT JOIN ("
        "SELECT a.alpha, k.row_id, c.intent, CAST(sum(CAST(round(1e9 * (ln(a.alpha) - ln(c.total + a.alpha * c.v))) AS BIGINT) + "
        "CASE WHEN n.n IS NULL THEN 0 ELSE CAST(round(1e9 * (ln(n.n + a.alpha) - ln(a.alpha))) AS BIGINT) END) AS BIGINT) AS score "
        f"FROM said k JOIN vocab USING (token) CROSS JOIN classes c CROSS JOIN (SELECT unnest({alphas}) AS alpha) a "
        "LEFT JOIN counts n ON n.token = k.token AND n.intent = c.intent "
        f"WHERE k.split = '{split}' GROUP BY a.alpha, k.row_id, c.intent) w "
        "ON w.row_id = s.row_id AND w.intent = c.intent AND w.alpha = a.alpha "
        f"WHERE s.split = '{split}'"
    )


def _bayes_counts(spark, sf_dir):
    """The counts of the train split, stored as the model they are."""
    return views.written(spark, sf_dir, "bayes_counts", lambda: bayes.train_counts(_clf_data(spark, sf_dir)[0]))


@register(
    "train_intent_bayes",
    _LABELLED + "SELECT intent, token, n FROM counts UNION ALL SELECT intent, NULL, docs FROM classes",
)
def q_train_intent_bayes(spark, sf_dir):
    """M1: the counts that are the naive Bayes model."""
    return bayes.train_counts(_clf_data(spark, sf_dir)[0])


@register(
    "predict_intents_bayes",
    _LABELLED + "SELECT row_id, intent AS intent_pred, '{\"intent\":\"' || intent || '\",\"params\":{}}' AS pred_text FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, intent) AS r FROM ({_scores_sql('test', '[1.0::DOUBLE]')}) x) y WHERE r = 1",
)
def q_predict_intents_bayes(spark, sf_dir):
    """M2: naive Bayes predictions for the test split as model JSON."""
    return bayes.predict(_bayes_counts(spark, sf_dir), _clf_data(spark, sf_dir)[2])


@register(
    "select_best_bayes",
    _LABELLED + ", losses AS (SELECT alpha, round(avg(loss), 6) AS val_log_loss, avg(loss) AS full_loss FROM ("
    "SELECT alpha, row_id, ln(sum(exp((score - top) / 1e9))) - max(CASE WHEN intent = truth THEN (score - top) / 1e9 END) AS loss FROM "
    "(SELECT *, max(score) OVER (PARTITION BY alpha, row_id) AS top FROM "
    f"({_scores_sql('val', '[1.0::DOUBLE, 0.1::DOUBLE, 0.01::DOUBLE]')}) x) y GROUP BY alpha, row_id) z GROUP BY alpha) "
    "SELECT alpha, val_log_loss, row_number() OVER (ORDER BY full_loss, alpha DESC) = 1 AS is_best FROM losses",
)
def q_select_best_bayes(spark, sf_dir):
    """M3: smoothing values with their validation log-loss; the best is flagged."""
    return rounded(bayes.select_best(_bayes_counts(spark, sf_dir), _clf_data(spark, sf_dir)[1]), "val_log_loss")
