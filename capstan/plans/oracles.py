"""DuckDB SQL with the same answers as the registered queries."""

from __future__ import annotations

from capstan.operators.bootstrap import PRIME, RESAMPLES, poisson_limits, resample_parameters

LENGTH = 64
SEED = 42


def tok(text: str) -> str:
    return (
        rf"list_filter(string_split_regex({text}, '[ \t\n\r\f\x0B\x1C-\x1F]+'), lambda x: x <> '')"
    )


def joined(column: str) -> str:
    return f"coalesce(array_to_string({column}, ','), '')"


CAPTIONS = """captions AS (
  SELECT doc_id // 5 AS image_id, 'img/' || (doc_id // 5) || '.png' AS image_path, doc_id AS caption_id,
         text AS caption, lang, source, lang AS split
  FROM documents)"""

WORDS = f"""words AS (
  SELECT caption_id, image_id, split, {tok("lower(caption)")} AS tokens FROM captions)"""

VOCAB = """vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 3 AS INTEGER) AS token_id, n
  FROM (SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM words) GROUP BY token))"""

ENCODED = """placed AS (
  SELECT caption_id, unnest(tokens) AS token, unnest(range(1, len(tokens) + 1)) AS pos FROM words),
encoded AS (
  SELECT w.caption_id, coalesce(e.ids, []) AS ids
  FROM words w LEFT JOIN (
    SELECT caption_id, list(token_id ORDER BY pos) AS ids FROM placed JOIN vocab USING (token) GROUP BY caption_id
  ) e USING (caption_id))"""

LABELS = f"""framed AS (
  SELECT caption_id, list_concat([2], list_concat(ids[1:{LENGTH - 2}], [3])) AS ids FROM encoded),
labelled AS (
  SELECT caption_id, list_resize(ids, {LENGTH}, -100) AS labels, len(ids) AS kept FROM framed)"""

PAIRS = f"""pairs AS (
  SELECT doc_id AS id, lang, source, r AS reference,
         list_filter(r, lambda x, i: ((i - 1) * 7 + doc_id) % 5 <> 0) AS prediction
  FROM (SELECT doc_id, lang, source, {tok("text")} AS r FROM documents))"""

CONV_TEXT = """conv AS (
  SELECT u.conv_id * 100 + u.turn AS id, u.text AS prediction, a.text AS reference
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

CONV_PAIRS = f"""{CONV_TEXT},
pairs AS (SELECT id, {tok("prediction")} AS prediction, {tok("reference")} AS reference FROM conv)"""


def overlap(groups: str = "") -> str:
    """Gram counts per pair; ``groups`` is a list of columns ending in a comma."""
    return f"""sides AS (
  SELECT id, {groups} 1 AS mine, prediction AS t FROM pairs
  UNION ALL SELECT id, {groups} 0 AS mine, reference AS t FROM pairs),
placed AS (
  SELECT id, {groups} mine, unnest(t) AS a, unnest(range(len(t))) AS pos FROM sides),
runs AS (
  SELECT *, lead(a, 1) OVER w AS b, lead(a, 2) OVER w AS c, lead(a, 3) OVER w AS d
  FROM placed WINDOW w AS (PARTITION BY id, mine ORDER BY pos)),
grams AS (
  SELECT id, {groups} mine, 1 AS n, a AS gram FROM runs
  UNION ALL SELECT id, {groups} mine, 2, a || chr(31) || b FROM runs WHERE b IS NOT NULL
  UNION ALL SELECT id, {groups} mine, 3, a || chr(31) || b || chr(31) || c FROM runs WHERE c IS NOT NULL
  UNION ALL SELECT id, {groups} mine, 4, a || chr(31) || b || chr(31) || c || chr(31) || d FROM runs
  WHERE d IS NOT NULL),
counted AS (
  SELECT id, {groups} n, gram, sum(mine) AS predicted, sum(1 - mine) AS expected
  FROM grams GROUP BY id, {groups} n, gram),
clipped AS (
  SELECT id, {groups} n, CAST(sum(least(predicted, expected)) AS BIGINT) AS matches,
         CAST(sum(predicted) AS BIGINT) AS predicted, CAST(sum(expected) AS BIGINT) AS expected
  FROM counted GROUP BY id, {groups} n)"""


def _bleu_parts(group: str) -> str:
    sums = ",\n".join(
        f"CAST(coalesce(sum(matches) FILTER (n = {n}), 0) AS BIGINT) AS c{n}, "
        f"CAST(coalesce(sum(predicted) FILTER (n = {n}), 0) AS BIGINT) AS t{n}"
        for n in range(1, 5)
    )
    lens = (
        "CAST(coalesce(sum(predicted) FILTER (n = 1), 0) AS BIGINT) AS sys_len, "
        "CAST(coalesce(sum(expected) FILTER (n = 1), 0) AS BIGINT) AS ref_len"
    )
    precision = ", ".join(
        f"CASE WHEN c1 + c2 + c3 + c4 = 0 OR t{n} = 0 THEN 0.0 "
        f"WHEN c{n} = 0 THEN 100.0 * 0.1::DOUBLE / t{n} ELSE 100.0::DOUBLE * c{n} / t{n} END AS p{n}"
        for n in range(1, 5)
    )
    key = f"{group}," if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""sums AS (SELECT {key} {sums}, {lens} FROM clipped {by}),
parts AS (
  SELECT *, {precision},
         CASE WHEN sys_len >= ref_len THEN 1.0::DOUBLE WHEN sys_len = 0 THEN 0.0
              ELSE exp(1.0 - ref_len::DOUBLE / sys_len) END AS bp
  FROM sums),
scored AS (
  SELECT *, CASE WHEN least(p1, p2, p3, p4) = 0 THEN 0.0
                 ELSE bp * exp((ln(p1) + ln(p2) + ln(p3) + ln(p4)) / 4) END AS score
  FROM parts)"""


def bleu(pairs: str = PAIRS, group: str = "") -> str:
    key = f"{group}," if group else ""
    return f"""WITH {pairs}, {overlap(key)}, {_bleu_parts(group)}
SELECT {key} round(score, 6) AS score,
       concat_ws(',', c1, c2, c3, c4) AS counts, concat_ws(',', t1, t2, t3, t4) AS totals,
       round(p1, 6) AS precision_1, round(p2, 6) AS precision_2,
       round(p3, 6) AS precision_3, round(p4, 6) AS precision_4,
       round(bp, 6) AS bp, sys_len, ref_len
FROM scored"""


def bleu_ratio(group: str) -> str:
    return f"""WITH {PAIRS}, {overlap(group + ",")}, {_bleu_parts(group)}
SELECT {group}, round(score / 100, 6) AS bleu, round(bp, 6) AS brevity_penalty,
       round(sys_len::DOUBLE / ref_len, 6) AS length_ratio,
       round(p1 / 100, 6) AS precision_1, round(p2 / 100, 6) AS precision_2,
       round(p3 / 100, 6) AS precision_3, round(p4 / 100, 6) AS precision_4,
       sys_len AS translation_length, ref_len AS reference_length
FROM scored"""


def rouge_rows(group: str = "") -> str:
    """Per pair ROUGE-1 and ROUGE-2 over all pairs, also those without grams."""
    key = f"p.{group}," if group else ""
    parts = ", ".join(
        f"coalesce(max(CASE WHEN predicted > 0 AND expected > 0 "
        f"THEN 2.0::DOUBLE * matches / (predicted + expected) ELSE 0.0 END) FILTER (n = {n}), 0.0) AS rouge{n}"
        for n in (1, 2)
    )
    return f"""rouge_rows AS (
  SELECT p.id, {key} {parts}
  FROM pairs p LEFT JOIN clipped o ON o.id = p.id GROUP BY {key} p.id)"""


def report() -> str:
    return f"""WITH {PAIRS}, {overlap("lang,")}, {_bleu_parts("lang")}, {rouge_rows("lang")},
rouge AS (
  SELECT lang, round(avg(rouge1), 6) AS rouge1, round(avg(rouge2), 6) AS rouge2, count(*) AS n_pairs
  FROM rouge_rows GROUP BY lang)
SELECT lang, round(score, 6) AS score, rouge1, rouge2, n_pairs FROM scored JOIN rouge USING (lang)"""


LOGITS = """positions AS (
  SELECT vec_id // 8 AS id, vec_id % 8 AS pos,
         CASE WHEN vec_id % 5 = 0 THEN -100 ELSE label END AS label,
         list_transform(embedding, lambda x: x::DOUBLE) AS logits
  FROM embeddings),
losses AS (
  SELECT id, pos, CASE WHEN label = -100 THEN 0.0 ELSE
           ln(list_sum(list_transform(logits, lambda x: exp(x)))) - logits[label + 1] END AS loss,
         CASE WHEN label = -100 THEN 0 ELSE 1 END AS counted
  FROM positions),
row_losses AS (
  SELECT id, sum(loss) AS loss, CAST(sum(counted) AS BIGINT) AS tokens FROM losses GROUP BY id)"""

ROW_LOSS = f"WITH {LOGITS} SELECT id, round(loss, 6) AS loss, tokens FROM row_losses"


def batch_losses(size: int) -> str:
    return f"""batch_losses AS (
  SELECT batch, count(*) AS n, sum(tokens) AS tokens, sum(loss) / sum(tokens) AS eval_loss
  FROM (SELECT *, (row_number() OVER (ORDER BY id) - 1) // {size} AS batch FROM row_losses)
  GROUP BY batch)"""


EVAL_LOG = f"""{LOGITS}, {batch_losses(4)},
eval_log AS (SELECT batch AS step, round(eval_loss, 6) AS eval_loss FROM batch_losses)"""

SEQUENCES = f"""{CAPTIONS},
sequences AS (
  SELECT image_id, caption_id, list_concat(['[CLS]'], list_concat({tok("lower(caption)")}, ['[SEP]'])) AS seq
  FROM captions)"""


# The tokens of the labels: cut where the labels are cut.
LABEL_SEQUENCES = f"""{CAPTIONS},
sequences AS (
  SELECT image_id, caption_id, split,
         list_concat(['[CLS]'], list_concat({tok("lower(caption)")}[1:{LENGTH - 2}], ['[SEP]'])) AS seq
  FROM captions)"""


def next_tokens(by: str = "", rows: str = "true") -> str:
    """The whole model of the sequences that ``rows`` picks."""
    key = f"{by}," if by else ""
    return f"""neighbours AS (
  SELECT {key} unnest(seq[1:len(seq) - 1]) AS prev, unnest(seq[2:len(seq)]) AS next FROM sequences WHERE {rows}),
bigrams AS (SELECT {key} prev, next, count(*) AS n FROM neighbours GROUP BY {key} prev, next),
model AS (
  SELECT {key} prev, next, logp, CAST(row_number() OVER (PARTITION BY {key} prev ORDER BY logp DESC, next) AS INTEGER) AS rank
  FROM (SELECT {key} prev, next,
               CAST(round(ln(n::DOUBLE / sum(n) OVER (PARTITION BY {key} prev)) * 1000000) AS BIGINT) AS logp
        FROM bigrams))"""


def beams(
    steps: int, key: str = "image_id", by: str = "image_id", size: int = 2, prompt: int = 0, beams: int = 5,
    fitted: str = "true", asked: str = "true", source: list[str] | None = None,
) -> str:
    """Unrolled search over the whole, uncut next-token table of the label sequences.

    ``key`` names the searches, ``by`` the key of the table (none: one for all),
    ``size`` the grams that may not repeat; a search starts with the first ``prompt`` words.
    ``source`` takes the place of the sequences and the model of their neighbours.
    """
    same = f"m.{by} = l.{by} AND" if by else ""
    gram = f"array_to_string(l.seq[i:i + {size - 1}], chr(31))"
    new = f"array_to_string(list_append(l.seq[len(l.seq) - {size - 2}:len(l.seq)], m.next), chr(31))"
    parts = [
        *(source or [LABEL_SEQUENCES, next_tokens(by, fitted)]),
        f"""live0 AS MATERIALIZED (
  SELECT DISTINCT {key}, list_filter(seq, lambda t: t <> '[SEP]')[1:{1 + prompt}] AS seq, 0::BIGINT AS logp, 0::BIGINT AS ends
  FROM sequences WHERE {asked})""",
    ]
    for k in range(steps):
        parts.append(
            f"""formed{k} AS MATERIALIZED (
  SELECT l.{key}, l.seq AS parent, list_append(l.seq, m.next) AS seq, l.logp + m.logp AS logp, l.ends,
         0 AS stuck, CAST(m.next = '[SEP]' AS INTEGER) AS ended
  FROM live{k} l JOIN model m ON {same} m.prev = l.seq[len(l.seq)]
  WHERE NOT list_contains(
    list_transform(range(1, greatest(1, len(l.seq) - {size - 2})), lambda i: {gram}), {new})),
ranked{k} AS (
  SELECT *, row_number() OVER w AS rk, sum((1 - ended) * (1 - stuck)) OVER w AS open_rk
  FROM (SELECT {key}, seq, logp, ends, stuck, ended FROM formed{k}
        UNION ALL
        SELECT {key}, seq, logp, ends, 1, 0 FROM live{k} l
        WHERE NOT EXISTS (SELECT 1 FROM formed{k} f WHERE f.{key} = l.{key} AND f.parent = l.seq))
  WINDOW w AS (PARTITION BY {key} ORDER BY stuck, logp DESC, seq)),
step{k} AS MATERIALIZED (
  SELECT {key}, seq, logp, stuck, ended, rk, open_rk,
         ends + sum(CASE WHEN ended = 1 AND rk <= {beams} THEN 1 ELSE 0 END) OVER (PARTITION BY {key}) AS ends
  FROM ranked{k}),
live{k + 1} AS MATERIALIZED (
  SELECT {key}, seq, logp, CAST(ends AS BIGINT) AS ends FROM step{k}
  WHERE ended = 0 AND stuck = 0 AND rk <= {2 * beams} AND open_rk <= {beams} AND ends < {beams})"""
        )
    done = [
        f"SELECT {key}, seq, logp, len(seq) - ended AS length FROM step{k} "
        f"WHERE stuck = 1 OR (ended = 1 AND rk <= {beams})"
        for k in range(steps)
    ]
    done.append(f"SELECT {key}, seq, logp, len(seq) AS length FROM live{steps}")
    parts.append("hypotheses AS (\n" + "\nUNION ALL ".join(done) + ")")
    parts.append(
        f"""generated AS (
  SELECT {key}, coalesce(array_to_string(list_filter(seq, lambda t: t NOT IN ('[CLS]', '[SEP]')), ' '), '') AS predicted, score
  FROM (SELECT *, logp / 1000000.0::DOUBLE / length AS score,
               row_number() OVER (PARTITION BY {key} ORDER BY logp / 1000000.0::DOUBLE / length DESC, seq) AS best
        FROM hypotheses)
  WHERE best = 1)"""
    )
    return ",\n".join(parts)


def beam_result(steps: int, key: str = "image_id", digits: int = 6, **search) -> str:
    return f"""WITH {beams(steps, key, **search)}
SELECT {key}, predicted, round(score, {digits}) AS score FROM generated"""


def prediction_rows(steps: int, key: str = "image_id", by: str = "image_id", **search) -> str:
    """Predictions whose loss is summed over the label ids themselves, turned back into tokens."""
    labels = f"{WORDS}, {VOCAB}, {ENCODED}, {LABELS}"
    same = f"m.{by} = s.{by} AND" if by else ""
    asked = search.get("asked", "true")
    return f"""{beams(steps, key, by, **search)},
{labels},
label_ids AS (
  SELECT caption_id, unnest(labels) AS id, unnest(range(1, len(labels) + 1)) AS pos FROM labelled),
label_tokens AS (
  SELECT caption_id, pos, CASE WHEN id = 2 THEN '[CLS]' WHEN id = 3 THEN '[SEP]' ELSE token END AS next
  FROM label_ids LEFT JOIN vocab ON token_id = id WHERE id <> -100),
label_steps AS (
  SELECT *, lag(next) OVER (PARTITION BY caption_id ORDER BY pos) AS prev FROM label_tokens),
caption_loss AS (
  SELECT s.caption_id, sum(-coalesce(logp, -13815511)) / 1000000.0::DOUBLE AS loss, count(*) AS tokens
  FROM label_steps t JOIN sequences s USING (caption_id)
  LEFT JOIN model m ON {same} m.prev = t.prev AND m.next = t.next
  WHERE t.prev IS NOT NULL GROUP BY s.caption_id),
predictions AS (
  SELECT s.caption_id AS id, loss, tokens, predicted AS predicted_labels,
         array_to_string(list_filter(seq, lambda t: t NOT IN ('[CLS]', '[SEP]')), ' ') AS labels
  FROM sequences s JOIN caption_loss USING (caption_id) JOIN generated g ON g.{key} = s.{key} WHERE {asked})"""


def predictions() -> str:
    return f"""WITH {prediction_rows(16)}
SELECT id, round(loss, 6) AS loss, predicted_labels, coalesce(labels, '') AS labels FROM predictions"""


def predictions_heldout() -> str:
    rows = prediction_rows(
        2, "caption_id", "", prompt=1, beams=3, fitted="split <> 'de'", asked="split = 'de'"
    )
    return f"""WITH {rows}
SELECT id, round(loss, 6) AS loss, tokens, predicted_labels, coalesce(labels, '') AS labels FROM predictions"""


def evaluate_job() -> str:
    text = "list_filter(string_split({}, ' '), lambda x: x <> '')"
    return f"""WITH predictions AS (WITH {prediction_rows(16)} SELECT * FROM predictions),
pairs AS (
  SELECT id, {text.format("predicted_labels")} AS prediction, {text.format("coalesce(labels, '')")} AS reference
  FROM predictions),
{overlap()}, {_bleu_parts("")}, {rouge_rows()},
batches AS (
  SELECT batch, count(*) AS n, sum(tokens) AS tokens, sum(loss) / sum(tokens) AS eval_loss
  FROM (SELECT *, (row_number() OVER (ORDER BY id) - 1) // 32 AS batch FROM predictions) GROUP BY batch),
losses AS (
  SELECT round(sum(eval_loss * n) / sum(n), 6) AS eval_loss, CAST(sum(tokens) AS BIGINT) AS n_tokens FROM batches),
rouge AS (
  SELECT round(avg(rouge1), 6) AS rouge1, round(avg(rouge2), 6) AS rouge2, count(*) AS n_pairs FROM rouge_rows)
SELECT CAST(0 AS BIGINT) AS step, 5 AS num_beams, round(score, 6) AS score, rouge1, rouge2, eval_loss, n_tokens, n_pairs
FROM scored CROSS JOIN rouge CROSS JOIN losses"""


def metrics_with_nulls() -> str:
    pairs = f"""{CONV_TEXT},
pairs AS (
  SELECT id, CASE WHEN id % 7 <> 0 THEN {tok("prediction")} ELSE [] END AS prediction,
         CASE WHEN id % 5 <> 0 THEN {tok("reference")} ELSE [] END AS reference FROM conv)"""
    return f"""WITH RECURSIVE {pairs}, {overlap()}, {_bleu_parts("")}, {rouge_rows()}, {LCS},
lcs AS (
  SELECT avg(CASE WHEN len(prediction) = 0 OR len(reference) = 0 THEN 0.0
    ELSE 2.0::DOUBLE * v / (len(prediction) + len(reference)) END) AS "rougeL"
  FROM pairs p JOIN dp d ON d.id = p.id AND d.i = len(prediction) AND d.j = len(reference)),
rouge AS (SELECT avg(rouge1) AS rouge1, count(*) AS n_pairs FROM rouge_rows),
own AS (
  SELECT avg(CASE WHEN id % 7 <> 0 AND length(prediction) > CASE WHEN id % 5 <> 0 THEN length(reference) ELSE 0 END
             THEN 1.0 ELSE 0.0 END) AS longer FROM conv)
SELECT round(score, 6) AS score, round(rouge1, 6) AS rouge1, round("rougeL", 6) AS "rougeL", round(longer, 6) AS longer, n_pairs
FROM scored CROSS JOIN rouge CROSS JOIN lcs CROSS JOIN own"""


def bootstrap() -> str:
    values = ", ".join(f"({a}, {b})" for a, b in resample_parameters(SEED, RESAMPLES))
    weight = " + ".join(f"(draw >= {limit})::INTEGER" for limit in poisson_limits())
    return f"""WITH {PAIRS}, {overlap()}, {rouge_rows()},
hashed AS (
  SELECT rouge1 AS value, CAST('0x' || substr(md5('{SEED}:' || id), 1, 15) AS BIGINT) % {PRIME} AS h FROM rouge_rows),
resamples(a, b) AS (VALUES {values}),
draws AS (SELECT a, b, value, (h * a + b) % {PRIME} AS draw FROM hashed CROSS JOIN resamples),
means AS (
  SELECT a, b, sum(value * ({weight})) / sum({weight}) AS mean FROM draws GROUP BY a, b)
SELECT round(quantile_cont(mean, 0.025), 6) AS low, round(quantile_cont(mean, 0.5), 6) AS mid,
       round(quantile_cont(mean, 0.975), 6) AS high, (SELECT round(avg(value), 6) FROM hashed) AS mean
FROM means"""


METEOR_EXACT = f"""WITH {PAIRS},
placed AS (
  SELECT id, 1 AS mine, lower(unnest(prediction)) AS token, unnest(range(len(prediction))) AS pos FROM pairs
  UNION ALL
  SELECT id, 0, lower(unnest(reference)), unnest(range(len(reference))) FROM pairs),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id, mine, token ORDER BY pos DESC) AS k FROM placed),
matched AS (
  SELECT a.id, a.pos AS h, b.pos AS r FROM ranked a
  JOIN ranked b ON a.id = b.id AND a.token = b.token AND a.k = b.k AND a.mine = 1 AND b.mine = 0),
broken AS (
  SELECT id, CASE WHEN h = lag(h) OVER w + 1 AND r = lag(r) OVER w + 1 THEN 0 ELSE 1 END AS starts
  FROM matched WINDOW w AS (PARTITION BY id ORDER BY h)),
counts AS (SELECT id, CAST(count(*) AS INTEGER) AS matches, CAST(sum(starts) AS INTEGER) AS chunks FROM broken GROUP BY id),
sized AS (
  SELECT p.id, coalesce(matches, 0) AS matches, coalesce(chunks, 0) AS chunks,
         len(prediction)::DOUBLE AS nh, len(reference)::DOUBLE AS nr
  FROM pairs p LEFT JOIN counts c USING (id))
SELECT id, matches, chunks,
       round(CASE WHEN matches = 0 THEN 0.0 ELSE
         (matches / nh) * (matches / nr) / (0.9::DOUBLE * matches / nh + 0.1::DOUBLE * matches / nr)
         * (1 - 0.5::DOUBLE * pow(chunks::DOUBLE / matches, 3)) END, 6) AS meteor
FROM sized"""

# The prediction is a subsequence of the reference, so it is the longest one.
ROUGE_L = f"""WITH {PAIRS}
SELECT lang, round(avg(CASE WHEN len(prediction) = 0 OR len(reference) = 0 THEN 0.0
  ELSE 2.0::DOUBLE * len(prediction) / (len(prediction) + len(reference)) END), 6) AS "rougeL"
FROM pairs GROUP BY lang"""

# The table of the dynamic program, one row of it per round.
LCS = """dp AS (
  SELECT id, 0 AS i, unnest(range(0, len(reference) + 1)) AS j, 0 AS v FROM pairs
  UNION ALL
  SELECT id, i + 1, j, max(x) OVER (PARTITION BY id ORDER BY j) FROM (
    SELECT d.id, d.i, d.j,
           CASE WHEN d.j > 0 AND p.prediction[d.i + 1] = p.reference[d.j]
                THEN lag(d.v) OVER (PARTITION BY d.id ORDER BY d.j) + 1 ELSE d.v END AS x
    FROM dp d JOIN pairs p ON p.id = d.id WHERE d.i < len(p.prediction)))"""

ROUGE_L_CONV = f"""WITH RECURSIVE {CONV_PAIRS}, {LCS}
SELECT p.id, round(CASE WHEN len(prediction) = 0 OR len(reference) = 0 THEN 0.0
    ELSE 2.0::DOUBLE * v / (len(prediction) + len(reference)) END, 6) AS "rougeL"
FROM pairs p JOIN dp d ON d.id = p.id AND d.i = len(prediction) AND d.j = len(reference)"""

def _lines(side: str) -> str:
    """Tokens of the lines of one side, numbered."""
    return f"""SELECT id, unnest(range(len(parts))) AS n, unnest(list_transform(parts, lambda p: {tok("p")})) AS tokens
  FROM (SELECT id, string_split({side}, chr(10)) AS parts FROM conv)"""


# Tokens of a reference line count that lie on the walk back through the table of some
# line of the prediction; a token counts as often as the prediction has it at most.
ROUGE_LSUM = f"""WITH RECURSIVE {CONV_TEXT},
told AS ({_lines("reference")}),
asked AS ({_lines("prediction")}),
line_pairs AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY t.id, t.n, a.n) AS id, t.id AS conv_id, t.n, t.tokens AS reference, a.tokens AS prediction
  FROM told t JOIN asked a USING (id) WHERE len(t.tokens) > 0 AND len(a.tokens) > 0),
pairs AS (SELECT id, reference, prediction FROM line_pairs), {LCS},
grid AS MATERIALIZED (
  SELECT id, list(line ORDER BY i) AS cells FROM (SELECT id, i, list(v ORDER BY j) AS line FROM dp GROUP BY id, i) GROUP BY id),
walk AS (
  SELECT id, len(reference) AS r, len(prediction) AS p, NULL::BIGINT AS hit FROM pairs
  UNION ALL
  SELECT id, CASE WHEN same THEN r - 1 WHEN go_left THEN r ELSE r - 1 END, CASE WHEN same OR go_left THEN p - 1 ELSE p END,
         CASE WHEN same THEN r END
  FROM (SELECT w.id, r, p, reference[r] = prediction[p] AS same, cells[p][r + 1] > cells[p + 1][r] AS go_left
        FROM walk w JOIN pairs USING (id) JOIN grid USING (id) WHERE r > 0 AND p > 0)),
hits AS (
  SELECT conv_id, token, count(*) AS n
  FROM (SELECT DISTINCT conv_id, n, hit, reference[hit] AS token FROM walk JOIN line_pairs USING (id) WHERE hit IS NOT NULL)
  GROUP BY conv_id, token),
asked_tokens AS (
  SELECT conv_id, token, count(*) AS n FROM (SELECT id AS conv_id, unnest(tokens) AS token FROM asked) GROUP BY conv_id, token),
matched AS (
  SELECT conv_id AS id, sum(least(h.n, a.n)) AS n FROM hits h JOIN asked_tokens a USING (conv_id, token) GROUP BY conv_id),
sizes AS (
  SELECT id, (SELECT coalesce(sum(len(tokens)), 0) FROM told t WHERE t.id = c.id) AS nr,
         (SELECT coalesce(sum(len(tokens)), 0) FROM asked a WHERE a.id = c.id) AS np
  FROM conv c)
SELECT id, round(CASE WHEN coalesce(n, 0) = 0 THEN 0.0 ELSE 2.0::DOUBLE * n / (nr + np) END, 6) AS "rougeLsum"
FROM sizes LEFT JOIN matched USING (id)"""

_AXIS = """SELECT i, CAST(floor(x) AS INTEGER) AS lo, least(CAST(floor(x) AS INTEGER) + 1, 7) AS hi,
         CAST(floor((1 - (x - floor(x))) * 4194304 + 0.5) AS BIGINT) AS w_lo,
         CAST(floor((x - floor(x)) * 4194304 + 0.5) AS BIGINT) AS w_hi
  FROM (SELECT i, greatest(0.0, least(7.0, (i + 0.5::DOUBLE) * 8 / 224 - 0.5)) AS x FROM range(224) t(i))"""

IMAGE_PIXELS = f"""WITH {CAPTIONS},
axis AS ({_AXIS}),
grey AS (
  SELECT vec_id, list_transform(embedding,
    lambda x: CAST(least(255, greatest(0, floor((x::DOUBLE + 1) * 127.5::DOUBLE))) AS INTEGER)) AS q
  FROM embeddings),
source AS (
  SELECT vec_id, c, k,
         CASE WHEN vec_id % 3 = 0 OR c = 0 THEN q[k + 1] WHEN c = 1 THEN q[(k + 1) % 64 + 1] ELSE 255 - q[k + 1] END AS v
  FROM grey CROSS JOIN range(3) a(c) CROSS JOIN range(64) b(k)),
grid AS (SELECT vec_id, c, k // 8 AS y, k % 8 AS x, v FROM source),
wide AS (
  SELECT a.vec_id, a.c, a.y, i AS x, (a.v * w_lo + b.v * w_hi + 2097152) >> 22 AS v
  FROM axis JOIN grid a ON a.x = lo JOIN grid b ON b.vec_id = a.vec_id AND b.c = a.c AND b.y = a.y AND b.x = hi),
tall AS (
  SELECT a.vec_id, a.c, i AS y, a.x, (a.v * w_lo + b.v * w_hi + 2097152) >> 22 AS v
  FROM axis JOIN wide a ON a.y = lo JOIN wide b ON b.vec_id = a.vec_id AND b.c = a.c AND b.x = a.x AND b.y = hi),
summary AS (
  SELECT vec_id, CAST(count(*) AS INTEGER) AS n_values,
         round((avg(v) FILTER (c = 0) / 255 - 0.5) / 0.5, 4) AS mean_r,
         round((avg(v) FILTER (c = 1) / 255 - 0.5) / 0.5, 4) AS mean_g,
         round((avg(v) FILTER (c = 2) / 255 - 0.5) / 0.5, 4) AS mean_b,
         round((max(v) FILTER (c = 0 AND y = 40 AND x = 100) / 255.0::DOUBLE - 0.5) / 0.5, 4) AS red_40_100,
         round((max(v) FILTER (c = 2 AND y = 150 AND x = 7) / 255.0::DOUBLE - 0.5) / 0.5, 4) AS blue_150_7
  FROM tall GROUP BY vec_id)
SELECT caption_id, n_values, mean_r, mean_g, mean_b, red_40_100, blue_150_7
FROM captions JOIN summary ON vec_id = image_id"""

# Labels by the nearest mean vector, and the loss of the softmax of negative squared distances.
SCORED = """WITH vectors AS (
  SELECT vec_id AS id, label, k, embedding[k]::DOUBLE AS x FROM embeddings, range(1, 65) t(k)),
centres AS (SELECT label AS kind, k, avg(x) AS c FROM vectors GROUP BY label, k),
scores AS (
  SELECT id, label, kind, sum(2 * c * x - c * c) AS score FROM vectors JOIN centres USING (k) GROUP BY id, label, kind)
SELECT id, label, CAST(arg_max(kind, score) AS INTEGER) AS predicted,
       round(max(score) + ln(sum(exp(score - top))) - max(score) FILTER (kind = label), 4) AS loss
FROM (SELECT *, max(score) OVER (PARTITION BY id) AS top FROM scores) GROUP BY id, label"""


def predictions_model() -> str:
    """Captions of labels by a model of neighbours and mean features; losses of whole, unrounded scores."""
    source = [
        """captions AS MATERIALIZED (
  SELECT vec_id // 8 AS image_id, vec_id // 8 AS caption_id, string_agg('l' || label, ' ' ORDER BY vec_id) AS caption,
         'all' AS split
  FROM embeddings GROUP BY vec_id // 8)""",
        f"""sequences AS MATERIALIZED (
  SELECT image_id, caption_id, split, list_concat(['[CLS]'], list_concat({tok("caption")}, ['[SEP]'])) AS seq
  FROM captions)""",
        """features AS (
  SELECT vec_id // 8 AS image_id, k, avg(embedding[k]::DOUBLE) AS x FROM embeddings, range(1, 65) t(k) GROUP BY ALL),
placed_tokens AS (SELECT image_id, unnest(seq) AS token FROM sequences),
tokens AS (SELECT DISTINCT token FROM placed_tokens UNION SELECT unnest(['[PAD]', '[UNK]'])),
centres AS (SELECT token, k, avg(x) AS c FROM placed_tokens JOIN features USING (image_id) GROUP BY token, k),
products AS (SELECT image_id, token, sum(c * x) AS d FROM centres JOIN features USING (k) GROUP BY image_id, token),
follows AS (
  SELECT prev, next, count(*) AS n
  FROM (SELECT unnest(seq[1:len(seq) - 1]) AS prev, unnest(seq[2:len(seq)]) AS next FROM sequences) GROUP BY prev, next),
scores AS (
  SELECT i.image_id, p.token AS prev, q.token AS next, ln(coalesce(n, 0) + 1) + coalesce(d, 0) AS z
  FROM sequences i CROSS JOIN tokens p CROSS JOIN tokens q
  LEFT JOIN follows f ON f.prev = p.token AND f.next = q.token
  LEFT JOIN products r ON r.image_id = i.image_id AND r.token = q.token),
model AS MATERIALIZED (
  SELECT *, CAST(floor(exact * 1000000 + 0.5::DOUBLE) AS BIGINT) AS logp
  FROM (SELECT image_id, prev, next, z - ln(sum(exp(z)) OVER (PARTITION BY image_id, prev)) AS exact FROM scores))""",
    ]
    return f"""WITH {beams(4, "image_id", "image_id", beams=3, source=source)},
steps AS (
  SELECT image_id, unnest(seq[1:len(seq) - 1]) AS prev, unnest(seq[2:len(seq)]) AS next FROM sequences),
losses AS (
  SELECT image_id, -sum(exact) AS loss, count(*) AS tokens FROM steps JOIN model USING (image_id, prev, next) GROUP BY image_id)
SELECT s.caption_id AS id, round(loss, 6) AS loss, tokens,
       array_to_string(list_filter(string_split(predicted, ' '), lambda t: t <> '[PAD]'), ' ') AS predicted_labels,
       caption AS labels
FROM captions s JOIN losses USING (image_id) JOIN generated USING (image_id)"""


LABEL_CTES = f"{CAPTIONS}, {WORDS}, {VOCAB}, {ENCODED}, {LABELS}"
LABEL_ROWS = f"WITH {LABEL_CTES} SELECT caption_id, {joined('labels')} AS labels FROM labelled"
LENGTHS = f"WITH {CAPTIONS} SELECT caption_id, CAST(len({tok('caption')}) AS INTEGER) AS length FROM captions"
LENGTH_SKETCH = f"""WITH lengths AS ({LENGTHS})
SELECT count(*) AS n, CAST(min(length) AS BIGINT) AS min_length, CAST(max(length) AS BIGINT) AS max_length,
       round(avg(length), 6) AS avg_length, round(avg(CASE WHEN length > {LENGTH} THEN 1.0 ELSE 0.0 END), 6) AS share_over,
       true AS p50_within, true AS p95_within, true AS p99_within
FROM lengths"""

# Steps 4, 8 and 12 of 13 are due; the batches of a step are its own.
TRAINING_LOG = """WITH positions AS (
  SELECT step, vec_id // 8 AS id, CASE WHEN vec_id % 5 = 0 THEN -100 ELSE label END AS label,
         list_transform(embedding, lambda x: x::DOUBLE * step / 10) AS logits
  FROM embeddings, (SELECT unnest([4, 8, 12]) AS step)),
rows AS (
  SELECT step, id, sum(CASE WHEN label = -100 THEN 0.0 ELSE
           ln(list_sum(list_transform(logits, lambda x: exp(x)))) - logits[label + 1] END) AS loss,
         sum(CASE WHEN label = -100 THEN 0 ELSE 1 END) AS tokens
  FROM positions GROUP BY step, id),
batches AS (
  SELECT step, count(*) AS n, sum(tokens) AS tokens, sum(loss) / sum(tokens) AS eval_loss
  FROM (SELECT *, (row_number() OVER (PARTITION BY step ORDER BY id) - 1) // 4 AS batch FROM rows) GROUP BY step, batch),
log AS (
  SELECT step, sum(eval_loss * n) / sum(n) AS eval_loss, sum(n) AS n_rows, sum(tokens) AS n_tokens FROM batches GROUP BY step)
SELECT 'only' AS run_id, CAST(step AS BIGINT) AS step, round(eval_loss, 6) AS eval_loss, CAST(n_rows AS BIGINT) AS n_rows,
       CAST(n_tokens AS BIGINT) AS n_tokens, eval_loss = min(eval_loss) OVER () AS kept
FROM log"""

WORD = r"[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\r\f\x0B\x1C-\x1F]"
CHARACTER = r"[^ \t\n\r\f\x0B\x1C-\x1F]"
NGRAM_CTES = f"WITH {PAIRS}, {overlap()}"

ORACLES: dict[str, str] = {
    "caption_scan": f"""WITH {CAPTIONS}
SELECT image_id AS id, caption_id, caption, split FROM captions WHERE split = 'de'""",
    "caption_lengths": LENGTHS,
    "caption_lengths_head": f"{LENGTHS} ORDER BY caption_id LIMIT 100",
    "length_profile": f"""WITH lengths AS ({LENGTHS})
SELECT count(*) AS n, min(length) AS min_length, max(length) AS max_length, round(avg(length), 6) AS avg_length,
       round(quantile_cont(length, 0.5), 6) AS p50, round(quantile_cont(length, 0.95), 6) AS p95,
       round(quantile_cont(length, 0.99), 6) AS p99,
       round(avg(CASE WHEN length > {LENGTH} THEN 1.0 ELSE 0.0 END), 6) AS share_over
FROM lengths""",
    "length_sketch": LENGTH_SKETCH,
    "stream_lengths": LENGTH_SKETCH,
    "lengths_csv": f"SELECT *, count(*) OVER () AS rows_written FROM ({LENGTHS})",
    "token_kinds": f"""WITH {CAPTIONS}, kinds AS (
  SELECT lang, 'whitespace' AS kind, {tok("caption")} AS tokens FROM captions
  UNION ALL SELECT lang, 'word', regexp_extract_all(caption, '{WORD}') FROM captions
  UNION ALL SELECT lang, 'char', regexp_extract_all(caption, '{CHARACTER}') FROM captions)
SELECT lang, kind, count(*) AS n, CAST(sum(len(tokens)) AS BIGINT) AS tokens, CAST(max(len(tokens)) AS INTEGER) AS most,
       CAST(sum(CAST('0x' || substr(md5({joined("tokens")}), 1, 8) AS BIGINT)) AS BIGINT) AS contents
FROM kinds GROUP BY lang, kind""",
    "shuffle_head": f"""WITH {CAPTIONS}
SELECT caption_id, image_id, lang, md5('{SEED}:' || caption_id) AS shuffle_key
FROM captions ORDER BY shuffle_key, caption_id LIMIT 100""",
    "shuffle_rank": f"""WITH {CAPTIONS}
SELECT caption_id, image_id, row_number() OVER (ORDER BY md5('{SEED}:' || caption_id), caption_id) AS position
FROM captions""",
    "buffer_shuffle": "SELECT doc_id AS caption_id, true AS in_reach FROM documents",
    "train_buffer": f"""WITH {LABEL_CTES}
SELECT caption_id, image_id AS id, {joined('labels')} AS labels, true AS gapless
FROM labelled JOIN captions USING (caption_id) WHERE split = 'en'""",
    "batch_assign": f"""WITH {CAPTIONS}
SELECT caption_id, (row_number() OVER (ORDER BY caption_id) - 1) // 32 AS batch FROM captions""",
    "train_data": f"""WITH {LABEL_CTES}, chosen AS (
  SELECT 'train' AS part, caption_id, image_id FROM captions WHERE split = 'en'
  UNION ALL
  (SELECT 'valid', caption_id, image_id FROM captions WHERE split <> 'en' ORDER BY caption_id LIMIT 1000))
SELECT part, caption_id, image_id AS id, {joined("labels")} AS labels, CAST(1 * 10000 // 32 AS BIGINT) AS max_steps
FROM chosen JOIN labelled USING (caption_id)""",
    "vocab_build": f"WITH {CAPTIONS}, {WORDS}, {VOCAB} SELECT token, token_id, n FROM vocab",
    "vocab_encode": f"""WITH {CAPTIONS}, {WORDS}, {VOCAB}, {ENCODED}
SELECT caption_id, CAST(len(ids) AS INTEGER) AS n, md5({joined("ids")}) AS ids_md5 FROM encoded""",
    "vocab_decode": f"""WITH {CAPTIONS}, {WORDS}
SELECT caption_id, coalesce(array_to_string(tokens, ' '), '') AS text FROM words""",
    "labels_pad_branch": f"""WITH {LABEL_CTES}
SELECT caption_id, {joined("labels")} AS labels, CAST(kept AS INTEGER) AS kept FROM labelled""",
    "labels_nopad_branch": LABEL_ROWS,
    "labels_unmask": f"""WITH {LABEL_CTES}
SELECT caption_id, {joined("list_transform(labels, lambda x: CASE WHEN x = -100 THEN 0 ELSE x END)")} AS ids,
       {joined("list_transform(labels, lambda x: CASE WHEN x = -100 THEN 3 ELSE x END)")} AS with_end,
       coalesce(array_to_string(tokens[1:{LENGTH - 2}], ' '), '') AS labels
FROM labelled JOIN words USING (caption_id)""",
    "pairs_join": f"WITH {CONV_TEXT} SELECT id, prediction, reference FROM conv",
    "union_predictions": f"""WITH {PAIRS}, sized AS (SELECT id, lang, CAST(len(prediction) AS INTEGER) AS n FROM pairs)
SELECT * FROM sized UNION ALL SELECT * FROM sized WHERE lang = 'en'""",
    "ngram_counts": f"""WITH {PAIRS}, {overlap()}
SELECT id, n, count(*) AS distinct_grams, CAST(sum(expected) AS BIGINT) AS grams,
       CAST(max(expected) AS BIGINT) AS most, min(gram) AS first_gram
FROM counted WHERE expected > 0 GROUP BY id, n""",
    "ngram_clipped": f"{NGRAM_CTES} SELECT id, n, matches, predicted, expected FROM clipped",
    "bleu_corpus": bleu(),
    "bleu_corpus_conv": bleu(CONV_PAIRS),
    "bleu_by_lang": bleu(group="lang"),
    "bleu_ratio_form": bleu_ratio("source"),
    "bleu_state_merge": bleu(group="lang"),
    "rouge1": f"{NGRAM_CTES}, {rouge_rows()} SELECT round(avg(rouge1), 6) AS rouge1 FROM rouge_rows",
    "rouge2": f"{NGRAM_CTES}, {rouge_rows()} SELECT round(avg(rouge2), 6) AS rouge2 FROM rouge_rows",
    "rouge_rows_conv": f"""WITH {CONV_PAIRS}, {overlap()}, {rouge_rows()}
SELECT id, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2 FROM rouge_rows""",
    "rouge_l": ROUGE_L,
    "rouge_l_rows_conv": ROUGE_L_CONV,
    "rouge_lsum": ROUGE_LSUM,
    "rouge_bootstrap": bootstrap(),
    "meteor_exact": METEOR_EXACT,
    "user_metric": f"SELECT lang, score FROM ({bleu(group='lang')})",
    "metrics_report": report(),
    "ce_row_loss": ROW_LOSS,
    "ce_row_loss_arrays": ROW_LOSS,
    "split_vocabulary_loss": ROW_LOSS,
    "eval_loss_batched": f"""WITH {LOGITS}, {batch_losses(32)}
SELECT round(sum(eval_loss * n) / sum(n), 6) AS eval_loss, CAST(sum(n) AS BIGINT) AS n_rows,
       CAST(sum(tokens) AS BIGINT) AS n_tokens FROM batch_losses""",
    "eval_loss_token": f"""WITH {LOGITS}
SELECT round(sum(loss) / sum(counted), 6) AS token_loss, CAST(sum(counted) AS BIGINT) AS n_tokens FROM losses""",
    "eval_schedule": f"""WITH {EVAL_LOG}, steps AS (SELECT CAST(count(*) // 4 AS BIGINT) AS max_steps FROM row_losses)
SELECT step, eval_loss, max_steps FROM eval_log CROSS JOIN steps
WHERE step > 0 AND step % 5 = 0 AND step <= max_steps""",
    "best_checkpoint": f"""WITH {EVAL_LOG}
SELECT step, eval_loss FROM eval_log ORDER BY eval_loss, step LIMIT 1""",
    "runs_table": f"""WITH {LOGITS}
SELECT run_id, CAST(0 AS BIGINT) AS step, random_seed, 64 AS max_sequence_length,
       round(sum(loss) / sum(counted), 6) AS token_loss, CAST(sum(counted) AS BIGINT) AS n_tokens,
       32.0::DOUBLE AS eval_samples_per_second, 1.0::DOUBLE AS eval_steps_per_second
FROM losses CROSS JOIN (VALUES ('first', 1), ('second', 2)) AS runs(run_id, random_seed)
GROUP BY run_id, random_seed""",
    "training_log": TRAINING_LOG,
    "next_token_table": f"WITH {SEQUENCES}, {next_tokens()} SELECT prev, next, rank, logp FROM model",
    "next_token_by_picture": f"""WITH {SEQUENCES}, {next_tokens("image_id")}
SELECT image_id, prev, next, rank, logp FROM model""",
    "beam_step1": beam_result(1),
    "beam_search": beam_result(16),
    "beam_search_shared": beam_result(3, "caption_id", 9, by="", prompt=2),
    "beam_no_repeat3": beam_result(8, size=3),
    "predictions_table": predictions(),
    "predictions_heldout": predictions_heldout(),
    "evaluate_job": evaluate_job(),
    "predictions_model": predictions_model(),
    "metrics_with_nulls": metrics_with_nulls(),
    "head_many": f"WITH {CAPTIONS} SELECT caption_id, lang FROM captions ORDER BY lang, caption_id LIMIT 333",
    "batch_inference": SCORED,
    "user_batches": "SELECT doc_id AS caption_id, CAST(length(strip_accents(text)) AS INTEGER) AS length FROM documents",
    "image_pixels": IMAGE_PIXELS,
    "train_pixels": f"""SELECT caption_id, caption_id // 5 AS id, n_values, mean_r, mean_g, mean_b
FROM ({IMAGE_PIXELS}) JOIN documents ON doc_id = caption_id WHERE lang = 'de'""",
    "stream_prepare": LABEL_ROWS,
    "stream_predict": f"SELECT id, predicted, loss FROM ({SCORED})",
    "stream_metrics": report(),
    "stream_metrics_once": report(),
    "stream_predict_once": f"SELECT id, predicted, loss FROM ({SCORED})",
    "stream_sums": f"""WITH lengths AS ({LENGTHS})
SELECT lang, count(*) AS n, CAST(sum(length) AS BIGINT) AS length
FROM lengths JOIN documents ON doc_id = caption_id GROUP BY lang""",
    "source_scan": f"""WITH {CAPTIONS}
SELECT image_id, image_path, caption_id, caption, 8 AS height FROM captions WHERE split = 'de'""",
    "source_stream": LENGTHS,
}
