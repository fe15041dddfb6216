"""SQL of the check views; the same text runs in Spark and in DuckDB.

Documents are plain prose, so each row gets a leading review sentence. All rows and the whole
text of each are kept.
"""

REVIEWS = """
SELECT d.doc_id AS review_id,
       p.p_name AS beer_name,
       d.source AS style,
       CAST(CASE d.doc_id % 8 WHEN 0 THEN 4.5 WHEN 1 THEN 4.0 WHEN 2 THEN 1.5 WHEN 3 THEN 3.0
                         WHEN 4 THEN 4.25 WHEN 5 THEN 2.0 WHEN 6 THEN 3.25 ELSE 2.75 END
         + CASE WHEN d.doc_id % 11 = 0 THEN 0.5 WHEN d.doc_id % 13 = 0 THEN -0.5 ELSE 0.0 END AS DOUBLE) AS rating_overall,
       CASE WHEN d.doc_id % 97 = 50 THEN NULL ELSE concat(
         CASE d.doc_id % 8
           WHEN 0 THEN 'Ask info@taproom.example about bottle 12: the glass came flat, it isn''t what the list at www.taproom.example.org/beers?id=7 said.'
           WHEN 1 THEN '<p title="malt > yeast">Cask night &amp; quiz; 2 < 3 rounds, we <3 the smoke, score > 6.</p> You&apos;ll find it&#0039;s sooooo good.'
           WHEN 2 THEN 'Thick like syrup!!! They''d have to pay me... I WON''T order it twice, what a disappointment.'
           WHEN 3 THEN 'Lemon rind then pepper, medium body, a dry crisp end; see http://cellar.example.net/log. I can''t place the yeast.'
           WHEN 4 THEN '麦の風味が強く、後味は軽い。 Roasted nuts, toffee and plum, a thick texture.'
           WHEN 5 THEN 'Flat, skunky, thin!!! I''d never carry a six-pack home. WON''T finish this one...'
           WHEN 6 THEN 'It''s fine: amber colour, thin lacing, light hop bite.'
           ELSE 'Plain bottle. Sour edge, hoppy tail, can''t say more.' END,
         ' ', d.text) END AS text
FROM {documents} d JOIN {part} p ON p.p_partkey = d.doc_id % 200
"""

PREDICTIONS = """
SELECT r.review_id, r.text,
       CASE WHEN r.rating_overall >= 4.0 THEN 'Positive' WHEN r.rating_overall <= 2.5 THEN 'Negative' ELSE 'Neutral' END AS true_label,
       CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'LABEL_2' ELSE 'neutral' END AS raw_pred_a,
       CASE WHEN lower(coalesce(r.text, '')) LIKE '%good%' OR lower(coalesce(r.text, '')) LIKE '%crisp%' THEN 'positive'
            WHEN lower(coalesce(r.text, '')) LIKE '%flat%' OR lower(coalesce(r.text, '')) LIKE '%disappoint%' THEN 'LABEL_0'
            ELSE 'neutral' END AS raw_pred_b
FROM {reviews} r LEFT JOIN {labels} l ON l.doc_id = r.review_id
"""

# One row per Japanese text. Texts that only src1 holds are missing and those of the lowest
# rating are empty, so both fallbacks are taken.
TRANSLATION_MEMORY = """
SELECT text AS source_text,
       CASE WHEN min(rating_overall) < 4.0 THEN ''
            ELSE replace(text, '麦の風味が強く、後味は軽い。', 'Strong malt, a light finish.') END AS translated
FROM {reviews}
WHERE text LIKE '麦の風味%' AND style <> 'src1'
GROUP BY text
"""
