"""The SQL each query is checked against: plain joins over the same views, multiplied rows and all."""

from __future__ import annotations

from cartrail import schemas
from cartrail.plans import wording
from workload.binding import LEXICON, MODIFIED_LEXICON, PHRASES

_CASED = "CASE ({by}) % 3 WHEN 0 THEN upper({c}) WHEN 1 THEN lower({c}) ELSE {title} END"


def _cased(column: str, by: str, title: str | None = None) -> str:
    simple = f"upper(substr({column}, 1, 1)) || lower(substr({column}, 2))"
    return _CASED.format(c=column, by=by, title=title or simple)


def _copies(marked: str) -> str:
    return f"unnest(CASE WHEN {marked} THEN [0, 1] ELSE [0] END)"


_VIEWS = f"""
journey AS (
  SELECT event_id AS JourneyID, user_id AS CustomerID, CAST(json_extract_string(props, '$.k') AS BIGINT) AS ProductID,
         CAST(ts AS DATE) AS VisitDate,
         CASE event_id % 3 WHEN 0 THEN 'homepage' WHEN 1 THEN 'productpage' ELSE 'checkout' END AS Stage,
         CASE WHEN event_type = 'error' THEN 'drop-off' ELSE event_type END AS Action,
         CASE WHEN event_type = 'error' THEN NULL ELSE value END AS Duration
  FROM events),
customers AS (
  SELECT c_custkey AS CustomerID, c_name AS CustomerName, 'c' || c_custkey || '@example.com' AS Email,
         upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS Gender,
         CAST(18 + c_custkey % 70 AS INTEGER) AS Age, CAST(c_nationkey AS BIGINT) AS GeographyID
  FROM customer),
geography AS (
  SELECT CAST(n_nationkey AS BIGINT) AS GeographyID, r_name AS Country, n_name AS City
  FROM nation JOIN region ON n_regionkey = r_regionkey),
products AS (
  SELECT p_partkey AS ProductID, p_name AS ProductName, p_type AS Category,
         CAST(p_retailprice AS DECIMAL(10, 2)) AS Price
  FROM part),
reviews AS (
  SELECT l_orderkey * 10 + l_linenumber AS ReviewID, o_custkey AS CustomerID, l_partkey AS ProductID,
         CAST(l_shipdate AS DATE) AS ReviewDate, CAST(1 + floor((l_quantity - 1) / 10) AS INTEGER) AS Rating,
         [{", ".join("'" + phrase.replace("'", "''") + "'" for phrase in PHRASES)}][l_suppkey % 10 + 1] AS ReviewText
  FROM lineitem LEFT JOIN (SELECT o_orderkey, min(o_custkey) AS o_custkey FROM orders GROUP BY 1) buyers
    ON l_orderkey = o_orderkey
  WHERE l_linestatus = 'O'),
engagement AS (
  SELECT l_orderkey * 10 + l_linenumber AS EngagementID, l_suppkey AS ContentID, l_returnflag AS ContentType,
         CAST(round(l_tax * 100) AS INTEGER) AS Likes, CAST(l_shipdate AS DATE) AS EngagementDate,
         CAST(l_linenumber AS BIGINT) AS CampaignID, l_partkey AS ProductID,
         CAST(floor(l_extendedprice) AS INTEGER) AS Views, CAST(l_quantity AS INTEGER) AS Clicks
  FROM lineitem WHERE l_linestatus = 'F'),
raw_journey AS (
  SELECT JourneyID, CustomerID, ProductID, VisitDate, {_cased("Stage", "JourneyID")} AS Stage,
         {_cased("Action", "JourneyID + 1", "CASE Action WHEN 'drop-off' THEN 'Drop-off' ELSE upper(substr(Action, 1, 1)) || substr(Action, 2) END")} AS Action,
         Duration
  FROM (SELECT *, {_copies("JourneyID % 10 = 0")} AS copied FROM journey)),
raw_reviews AS (
  SELECT ReviewID, CustomerID, ProductID, ReviewDate, Rating,
         CASE WHEN ReviewID % 7 = 0 THEN NULL
              WHEN ReviewID % 5 = 0 THEN ' ' || chr(9) || ReviewText || chr(10) || ' ' ELSE ReviewText END AS ReviewText
  FROM (SELECT *, {_copies("ReviewID % 10 = 0")} AS copied FROM reviews)),
raw_customers AS (
  SELECT CustomerID, CustomerName, Email, {_cased("Gender", "CustomerID")} AS Gender,
         CASE WHEN CustomerID % 7 = 0 THEN NULL ELSE CAST(CustomerID % 130 + copied AS INTEGER) END AS Age,
         GeographyID, CustomerID * 2 + copied AS arrival
  FROM (SELECT *, {_copies("CustomerID % 10 = 0")} AS copied FROM customers)),
raw_engagement AS (
  SELECT EngagementID, ContentID, {_cased("ContentType", "EngagementID")} AS ContentType, Likes, EngagementDate,
         CampaignID, ProductID,
         CASE WHEN EngagementID % 11 = 0 THEN CAST(Views AS VARCHAR)
              WHEN EngagementID % 13 = 0 THEN Views || '-x' ELSE Views || '-' || Clicks END AS ViewsClicksCombined
  FROM (SELECT *, {_copies("EngagementID % 10 = 0")} AS copied FROM engagement)),
raw_geography AS (
  SELECT GeographyID, Country, City
  FROM (SELECT *, {_copies("GeographyID % 4 = 0")} AS copied FROM geography)),
raw_products AS (
  SELECT ProductID, ProductName, Category,
         CAST(CASE WHEN ProductID % 11 = 0 THEN 0 WHEN ProductID % 13 = 0 THEN -Price ELSE Price END AS DECIMAL(10, 2)) AS Price
  FROM (SELECT *, {_copies("ProductID % 10 = 0")} AS copied FROM products)),
lexicon(word, polarity) AS (VALUES {", ".join(f"('{word.replace(chr(39), chr(39) * 2)}', CAST({value} AS DOUBLE))" for word, value in LEXICON.items())})
"""

_RAW = {
    "customer_journey": "raw_journey",
    "customer_reviews": "raw_reviews",
    "customers": "raw_customers",
    "engagement_data": "raw_engagement",
    "geography": "raw_geography",
    "products": "raw_products",
}

_PAIR = "regexp_full_match(ViewsClicksCombined, '[0-9]+-[0-9]+')"

_CLEAN = f"""
clean_journey AS (
  SELECT DISTINCT JourneyID, CustomerID, ProductID, VisitDate, lower(Stage) AS Stage, lower(Action) AS Action,
         coalesce(Duration, 0.0) AS Duration
  FROM raw_journey),
clean_reviews AS (
  SELECT DISTINCT ReviewID, CustomerID, ProductID, ReviewDate, Rating,
         trim(coalesce(ReviewText, 'No review'), ' ' || chr(9) || chr(10)) AS ReviewText
  FROM raw_reviews),
clean_customers AS (
  SELECT CustomerID, CustomerName, Email, upper(substr(Gender, 1, 1)) || lower(substr(Gender, 2)) AS Gender,
         CASE WHEN Age < 18 THEN 18 WHEN Age > 100 THEN 100 ELSE Age END AS Age, GeographyID
  FROM raw_customers QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY arrival) = 1),
clean_engagement AS (
  SELECT DISTINCT EngagementID, ContentID, upper(ContentType) AS ContentType, Likes, EngagementDate, CampaignID,
         ProductID,
         CASE WHEN {_PAIR} THEN CAST(split_part(ViewsClicksCombined, '-', 1) AS INTEGER) END AS Views,
         CASE WHEN {_PAIR} THEN CAST(split_part(ViewsClicksCombined, '-', 2) AS INTEGER) END AS Clicks
  FROM raw_engagement),
clean_geography AS (SELECT DISTINCT * FROM raw_geography),
clean_products AS (SELECT DISTINCT * FROM raw_products WHERE Price > 0)
"""

_CLEANED = {name: view.replace("raw_", "clean_") for name, view in _RAW.items()}


def _sql(body: str, *more: str) -> str:
    return "WITH " + ", ".join([_VIEWS.strip(), *[part.strip() for part in more]]) + "\n" + body.strip()


def _ratio(part: str, whole: str, digits: int) -> str:
    """Half-up rounding in whole numbers; parts are never negative here."""
    scale = 10**digits
    part, whole = f"CAST({part} AS BIGINT)", f"nullif(CAST({whole} AS BIGINT), 0)"
    return f"CAST(({2 * scale} * {part} + {whole}) // (2 * {whole}) AS DOUBLE) / CAST({scale} AS DOUBLE)"


def _pct(part: str, whole: str) -> str:
    return _ratio(f"100 * {part}", whole, 2)


def _avg(column: str, digits: int = 4) -> str:
    return _ratio(f"sum({column})", f"count({column})", digits)


_BUY = "Action = 'purchase'"
_CHECKOUT_BUY = "Stage = 'checkout' AND Action = 'purchase'"


def _count_where(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def _band(labels: tuple[str, str, str]) -> str:
    return f"CASE WHEN Age < 30 THEN '{labels[0]}' WHEN Age BETWEEN 30 AND 45 THEN '{labels[1]}' ELSE '{labels[2]}' END"


_RANGES = _band(("<30", "30-45", ">45"))
_GROUPS = _band(("18-29", "30-45", "46+"))
_DOUBLE = "CAST({} AS DOUBLE)"

_JP = "journey JOIN products USING (ProductID)"
_RP = "reviews JOIN products USING (ProductID)"
_JC = "journey JOIN customers USING (CustomerID)"
_JCG = f"{_JC} JOIN geography USING (GeographyID)"
_BOUGHT = f"(SELECT * FROM journey WHERE {_BUY})"


def _demographic(label: str, value: str, source: str) -> str:
    return f"""SELECT '{label}' AS Group_By, {value} AS Group_Value, count(DISTINCT CustomerID) AS Total_Customers,
      {_count_where(_CHECKOUT_BUY)} AS Total_Purchases,
      {_pct(_count_where(_CHECKOUT_BUY), "count(DISTINCT CustomerID)")} AS Conversion_Rate
    FROM {source} GROUP BY 2"""


# reports that other reports or the recommendation lines build on
_CORE = {
    "top_products": f"""SELECT ProductName, count(JourneyID) AS Total_Interactions FROM {_JP}
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "top_regions": f"""SELECT Country, count(JourneyID) AS Total_Purchases FROM {_JCG}
        WHERE {_BUY} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "customer_retention": """SELECT CASE WHEN visits > 1 THEN 'Retained' ELSE 'One-Time' END AS Customer_Type,
        count(*) AS "Count"
        FROM (SELECT CustomerID, count(DISTINCT VisitDate) AS visits FROM journey GROUP BY 1) GROUP BY 1""",
    "demographics_conversion": " UNION ALL ".join(
        [
            _demographic("Age Range", _RANGES, _JC),
            _demographic("Gender", "Gender", _JC),
            _demographic("Country", "Country", _JCG),
        ]
    ),
    "product_conversion": f"""SELECT ProductName,
          {_ratio("sum(CAST(Price * 100 AS BIGINT))", "100 * count(Price)", 2)} AS Avg_Price,
          count(DISTINCT CustomerID) AS Unique_Customers, {_count_where(_CHECKOUT_BUY)} AS Total_Purchases,
          {_pct(_count_where(_CHECKOUT_BUY), "count(DISTINCT CustomerID)")} AS Conversion_Rate
        FROM {_JP} GROUP BY 1""",
    "engagement_conversion": f"""SELECT ContentType, count(DISTINCT EngagementID) AS Total_Engagements,
          {_DOUBLE.format(_count_where(_CHECKOUT_BUY))} AS Total_Purchases,
          {_pct(_count_where(_CHECKOUT_BUY), "count(DISTINCT EngagementID)")} AS Conversion_Rate
        FROM engagement JOIN journey USING (ProductID) GROUP BY 1""",
    "review_sentiment": f"""SELECT ProductID, ProductName, ReviewText, Rating,
        CASE WHEN Rating > 3 THEN 1 WHEN Rating = 3 THEN 0 ELSE -1 END AS Sentiment FROM {_RP}""",
    "underperforming_products": f"""SELECT p.ProductName, {_avg("r.Rating")} AS AvgRating,
          {_DOUBLE.format("count(j.JourneyID)")} AS PurchaseCount
        FROM products p LEFT JOIN reviews r ON p.ProductID = r.ProductID
        LEFT JOIN journey j ON p.ProductID = j.ProductID AND j.Action = 'purchase'
        GROUP BY 1 ORDER BY 2 ASC NULLS FIRST, 3, 1 LIMIT 5""",
    "channel_performance": f"""SELECT ContentType, {_avg("Views")} AS AvgViews, {_avg("Clicks")} AS AvgClicks,
          {_DOUBLE.format("count(j.JourneyID)")} AS Purchases
        FROM engagement e LEFT JOIN journey j ON e.ProductID = j.ProductID AND j.Action = 'purchase' GROUP BY 1""",
    "lowest_rated_products": f"""SELECT ProductID, ProductName, {_avg("Rating")} AS AvgRating, count(*) AS ReviewCount
        FROM {_RP} GROUP BY 1, 2 ORDER BY 3 ASC NULLS FIRST, 1, 2 LIMIT 5""",
    "common_complaints": f"""SELECT ReviewText, ProductName, count(*) AS Frequency FROM {_RP} WHERE Rating <= 2
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
    "one_time_checkout_purchasers": f"""SELECT CustomerID, count(DISTINCT JourneyID) AS PurchaseCount FROM {_JC}
        WHERE {_CHECKOUT_BUY} GROUP BY 1 HAVING count(DISTINCT JourneyID) = 1""",
    "flagship_product": f"""SELECT ProductName, {_pct(_count_where(_BUY), "count(JourneyID)")} AS conversion_rate
        FROM {_JP} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "top_demographic": f"""SELECT {_GROUPS} AS age_group, Gender, Country,
          {_pct(_count_where(_BUY), "count(DISTINCT CustomerID)")} AS conversion_rate
        FROM {_JCG} GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2, 3 LIMIT 1""",
    "top_region_product": f"""SELECT Country, ProductName, count(*) AS sales
        FROM {_JCG} JOIN products USING (ProductID) WHERE {_BUY} GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 1""",
    "channel_roi": f"""SELECT ContentType, {_DOUBLE.format("sum(Clicks)")} AS total_clicks,
          {_DOUBLE.format(_count_where(_BUY))} AS conversions,
          {_pct(_count_where(_BUY), "sum(Clicks)")} AS conversion_rate
        FROM engagement JOIN journey USING (ProductID) GROUP BY 1""",
    "discount_candidates": f"""SELECT ProductName, {_avg("Rating")} AS avg_rating, count(ReviewID) AS review_count
        FROM products p LEFT JOIN reviews r ON p.ProductID = r.ProductID
        LEFT JOIN (SELECT ProductID FROM journey WHERE {_BUY} GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3) best
          ON p.ProductID = best.ProductID
        WHERE best.ProductID IS NULL GROUP BY 1 HAVING avg(Rating) < 3.5 AND count(ReviewID) > 5
        ORDER BY 2 NULLS FIRST, 1 LIMIT 1""",
}
_CORE["common_complaints_wide"] = _CORE["common_complaints"]
_CORE["sentiment_distribution"] = f"""SELECT Category, CAST(n AS DOUBLE) / sum(n) OVER () * CAST(100 AS DOUBLE) AS Percentage
    FROM (SELECT CASE WHEN Sentiment > 0 THEN 'Positive' WHEN Sentiment < 0 THEN 'Negative' ELSE 'Neutral' END AS Category,
          count(*) AS n FROM ({_CORE["review_sentiment"]}) GROUP BY 1)"""


def _reviews_scored(source: str, *columns: str) -> str:
    """Mean polarity per row of ``source``, through a row number."""
    kept = ", ".join(columns)
    return rf"""numbered AS (SELECT *, row_number() OVER () AS n FROM {source}),
words AS (SELECT n, lower(unnest(regexp_extract_all(ReviewText, '\p{{L}}+(?:[''’]\p{{L}}+)*'))) AS word FROM numbered),
means AS (
  SELECT n, CAST(sum(CAST(round(polarity * 10000) AS BIGINT)) AS DOUBLE) / CAST(count(*) * 10000 AS DOUBLE) AS score
  FROM words JOIN lexicon USING (word) GROUP BY n),
scored AS (SELECT {kept}, coalesce(score, CAST(0 AS DOUBLE)) AS SentimentScore FROM numbered LEFT JOIN means USING (n))"""


def _quoted(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def _scored_in_order(source: str, *columns: str) -> str:
    """Mean polarity per row of ``source`` under the lexicon with phrases and modifiers: a fold over its hits."""
    kept = ", ".join(columns)
    entries = ", ".join(f"({_quoted(word)}, '{kind}', {round(value * 10000)}::BIGINT)" for word, kind, value in MODIFIED_LEXICON)
    times = "CAST(round({} * {} / 10000::DOUBLE) AS BIGINT)"
    boosted = f"CASE WHEN s.boosts_at = h.place THEN {times.format('h.weight', 's.boost')} ELSE h.weight END"
    weight = f"CASE WHEN h.place <= s.turns_to THEN {times.format(f'({boosted})', 's.turn')} ELSE {boosted} END"
    again = f"CASE WHEN h.place <= s.turns_to THEN {times.format('h.weight', 's.turn')} ELSE h.weight END"
    state = "{{'free': {}, 'total': {}, 'n': {}, 'turn': {}, 'turns_to': {}, 'boost': {}, 'boosts_at': {}}}"
    none = ("1::BIGINT", "-1::BIGINT", "1::BIGINT", "-1::BIGINT")
    intensified = state.format("h.place + h.size", "s.total", "s.n", "s.turn", "s.turns_to", boosted, "h.place + h.size")
    negated = state.format("h.place + h.size", "s.total", "s.n", again, "h.place + h.size + 2", "s.boost", "s.boosts_at")
    counted = state.format("h.place + h.size", f"s.total + greatest(-10000, least(10000, {weight}))", "s.n + 1", *none)
    return rf"""entries(phrase, kind, weight) AS (VALUES {entries}),
numbered AS (SELECT *, row_number() OVER () AS n FROM {source}),
sentences AS (
  SELECT n, generate_subscripts(parts, 1) AS sentence, unnest(parts) AS part
  FROM (SELECT n, regexp_split_to_array(lower(ReviewText), '[.!?]+') AS parts FROM numbered)),
spelled AS (SELECT n, sentence, regexp_extract_all(part, '\p{{L}}+(?:[''’]\p{{L}}+)*') AS words FROM sentences),
places AS (SELECT n, sentence, words, unnest(generate_series(1, len(words))) AS i FROM spelled),
hits AS (
  SELECT n, sentence * 4294967296 + i AS place, len(string_split(phrase, ' ')) AS size, kind, weight
  FROM places JOIN entries ON words[i] = split_part(phrase, ' ', 1)
    AND array_to_string(words[i:i + len(string_split(phrase, ' ')) - 1], ' ') = phrase
  QUALIFY row_number() OVER (PARTITION BY n, sentence, i ORDER BY len(string_split(phrase, ' ')) DESC) = 1),
folded AS (
  SELECT n, list_reduce(list({{'place': place, 'size': size, 'kind': kind, 'weight': weight}} ORDER BY place), lambda s, h: CASE
      WHEN h.place < s.free THEN s WHEN h.kind = 'intensifier' THEN {intensified} WHEN h.kind = 'negation' THEN {negated} ELSE {counted} END,
    {state.format('-1::BIGINT', '0::BIGINT', '0::BIGINT', *none)}) AS f
  FROM hits GROUP BY n),
scored AS (
  SELECT {kept}, CASE WHEN f.n > 0 THEN CAST(f.total AS DOUBLE) / CAST(f.n * 10000 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS SentimentScore
  FROM numbered LEFT JOIN folded USING (n))"""


_DOCUMENTS = "(SELECT doc_id AS ReviewID, text AS ReviewText FROM documents)"
_RATED_DOCUMENTS = """(SELECT doc_id AS ReviewID, text AS ReviewText, CASE WHEN toxic = 1 AND quality <> 1 THEN 1
  WHEN quality <> 1 THEN 2 WHEN toxic = 1 THEN 3 ELSE 5 END AS Rating FROM documents JOIN labels USING (doc_id))"""


def _gate(threshold: str = "-0.2") -> str:
    return f"""SELECT CAST(count(*) AS BIGINT) AS negative_reviews, 
      round(CAST(sum(CAST(round(SentimentScore * 1000000000) AS HUGEINT)) AS DOUBLE) / (count(*) * CAST(1000000000 AS DOUBLE)), 4) AS avg_polarity,
      coalesce(sum(CAST(round(SentimentScore * 1000000000) AS HUGEINT)) < CAST({threshold} * 1000000000 AS HUGEINT) * count(*), false) AS dissatisfied
      FROM scored"""


# --- recommendation lines -------------------------------------------------------------------------------------


def _line(rule: str, section: int, line: str, source: str, sort_key: str = "0", sort_name: str = "''") -> str:
    return f"""SELECT '{rule}' AS "rule", {section} AS section, CAST({sort_key} AS DOUBLE) AS sort_key,
      {sort_name} AS sort_name, {line} AS line {source}"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _fill(template: str, *values: str) -> str:
    """Concatenate a wording template with SQL expressions in place of its placeholders."""
    pieces = template.replace("%%", "\0").split("%s")
    parts = [_text(pieces[0].replace("\0", "%"))]
    for value, piece in zip(values, pieces[1:], strict=True):
        parts += [f"CAST({value} AS VARCHAR)", _text(piece.replace("\0", "%"))]
    return " || ".join(parts)


def _best(report: str, rate: str, name: str, k: int) -> str:
    return f"(SELECT * FROM ({_CORE[report]}) ORDER BY {rate} DESC, {name} LIMIT {k})"


_TOP3 = _best("product_conversion", "Conversion_Rate", "ProductName", 3)
_TOP3_NAMES = f"""FROM (SELECT string_agg(ProductName, ', ' ORDER BY Conversion_Rate DESC, ProductName) AS names
  FROM {_TOP3}) WHERE names IS NOT NULL"""
_CONTENT = f"FROM {_best('engagement_conversion', 'Conversion_Rate', 'ContentType', 1)}"
_DISLIKED = f"(SELECT DISTINCT ProductName FROM ({_CORE['review_sentiment']}) WHERE Sentiment < 0)"


def _strategic() -> str:
    ages = f"FROM (SELECT * FROM ({_CORE['demographics_conversion']}) WHERE Group_By = 'Age Range' ORDER BY Conversion_Rate DESC, Group_Value LIMIT 1)"
    return " UNION ALL ".join(
        [
            _line("strategic", 1, _fill(wording.TOP_CONVERTING, "names"), _TOP3_NAMES),
            _line("strategic", 2, _fill(wording.BEST_CONTENT, "ContentType"), _CONTENT),
            _line("strategic", 3, _fill(wording.BEST_AGE, "Group_Value"), ages),
            _line("strategic", 4, _fill(wording.NEGATIVE_PRODUCTS, "ProductName"), f"FROM {_DISLIKED}", "0", "ProductName"),
            _line("strategic", 5, _text(wording.CHECKOUT), ""),
        ]
    )


def _text_report_lines() -> str:
    three = f"(SELECT * FROM {_DISLIKED} ORDER BY 1 LIMIT 3)"
    names = f"FROM (SELECT string_agg(ProductName, ', ' ORDER BY ProductName) AS names FROM {three}) WHERE names IS NOT NULL"
    return " UNION ALL ".join(
        [
            _line("text_report", 1, _fill(wording.REPORT_AGE, "age_group", "Country"), f"FROM ({_CORE['top_demographic']})"),
            _line("text_report", 2, _fill(wording.REPORT_TOP, "names"), _TOP3_NAMES),
            _line("text_report", 3, _fill(wording.REPORT_CONTENT, "ContentType"), _CONTENT),
            _line("text_report", 4, _text(wording.REPORT_CHECKOUT), ""),
            _line("text_report", 5, _fill(wording.REPORT_NEGATIVE, "names"), names),
        ]
    )


def _marketing() -> str:
    rating = "CASE WHEN AvgRating IS NULL THEN 'None' ELSE printf('%.4f', AvgRating) END"
    count = "CAST(CAST({} AS BIGINT) AS VARCHAR)"
    bought = count.format("PurchaseCount")
    return " UNION ALL ".join(
        [
            _line(
                "marketing", 1, _fill(wording.IMPROVE_PRODUCT, "ProductName", rating, bought),
                f"FROM ({_CORE['underperforming_products']})", "AvgRating",
                f"lpad({bought}, 38, '0') || '|' || ProductName",
            ),
            _line(
                "marketing", 2,
                _fill(
                    wording.BOOST_CHANNEL, "ContentType", "printf('%.4f', AvgViews)", "printf('%.4f', AvgClicks)",
                    count.format("Purchases"),
                ),
                f"FROM ({_CORE['channel_performance']})", "-Purchases", "ContentType",
            ),
        ]
    )


def _experience() -> str:
    lowest, complaints = f"FROM ({_CORE['lowest_rated_products']})", f"FROM ({_CORE['common_complaints']})"
    two_digits = "printf('%.2f', round_even(CAST(AvgRating AS DECIMAL(18, 4)), 2))"
    once = f"FROM (SELECT count(*) AS n FROM ({_CORE['one_time_checkout_purchasers']})) WHERE n > 0"
    return " UNION ALL ".join(
        [
            _line("experience", 1, _text(wording.DISSATISFIED), f"FROM ({_gate()}) WHERE dissatisfied"),
            _line("experience", 2, _text(wording.LOWEST_HEADER), f"FROM (SELECT count(*) AS n {lowest}) WHERE n > 0"),
            _line(
                "experience", 3, _fill(wording.LOWEST_ITEM, "ProductName", "ProductID", two_digits, "ReviewCount"),
                lowest, "AvgRating", "lpad(CAST(ProductID AS VARCHAR), 20, '0')",
            ),
            _line("experience", 4, _fill(wording.ONE_TIME, "n"), once),
            _line("experience", 5, _text(wording.COMPLAINT_HEADER), f"FROM (SELECT count(*) AS n {complaints}) WHERE n > 0"),
            _line(
                "experience", 6, _fill(wording.COMPLAINT_ITEM, "ReviewText", "ProductName", "Frequency"),
                complaints, "-Frequency", "ReviewText || '|' || ProductName",
            ),
        ]
    )


def _business() -> str:
    channel = _best("channel_roi", "conversion_rate", "ContentType", 1)
    discount = _fill(wording.DISCOUNT, "ProductName", "avg_rating", "review_count")
    return " UNION ALL ".join(
        [
            _line("business", 1, _fill(wording.FLAGSHIP, "ProductName", "conversion_rate"), f"FROM ({_CORE['flagship_product']})"),
            _line(
                "business", 2, _fill(wording.DEMOGRAPHIC, "age_group", "Gender", "Country", "conversion_rate"),
                f"FROM ({_CORE['top_demographic']})",
            ),
            _line("business", 3, _fill(wording.REGION, "ProductName", "Country", "sales"), f"FROM ({_CORE['top_region_product']})"),
            _line("business", 4, _fill(wording.CHANNEL, "ContentType", "conversion_rate"), f"FROM {channel}"),
            _line(
                "business", 5, f"coalesce(max({discount}), {_text(wording.NO_DISCOUNT)})",
                f"FROM ({_CORE['discount_candidates']})",
            ),
        ]
    )


def _findings() -> str:
    lost = "(SELECT Stage, count(*) AS n FROM journey WHERE Action = 'drop-off' GROUP BY 1)"
    best = f"(SELECT ProductID, {_avg('Rating')} AS rating FROM reviews GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)"
    fixed = [wording.DROP_OFF_HEADER, "", wording.RATED_HEADER]
    return " UNION ALL ".join(
        [
            f"SELECT unnest([{', '.join(_text(line) for line in fixed)}]) AS line",
            f"SELECT {_fill(wording.DROP_OFF_ITEM, 'Stage', 'n')} AS line FROM {lost}",
            f"""SELECT {_fill(wording.RATED_ITEM, 'ProductID', "printf('%.4f', rating)")} AS line FROM {best}""",
        ]
    )


# --- the plain-text report ------------------------------------------------------------------------------------


def _cells(*columns: str) -> str:
    texts = [f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in columns]
    return " || ' ' || ".join(f"CASE WHEN length({t}) < 20 THEN lpad({t}, 20, ' ') ELSE {t} END" for t in texts)


def _text_report() -> str:
    whole = "CAST(CAST({0} AS BIGINT) AS VARCHAR)"
    best = f"(SELECT * FROM ({_CORE['product_conversion']}) ORDER BY Conversion_Rate DESC, Total_Purchases DESC, ProductName LIMIT 5)"
    tables = [
        (wording.CHAPTER_TRENDS, wording.TABLE_PRODUCTS, f"({_CORE['top_products']})", ["ProductName", "Total_Interactions"]),
        ("", wording.TABLE_REGIONS, f"({_CORE['top_regions']})", ["Country", "Total_Purchases"]),
        ("", wording.TABLE_RETENTION, f"({_CORE['customer_retention']})", ["Customer_Type", '"Count"']),
        (wording.CHAPTER_SEGMENTS, wording.TABLE_DEMOGRAPHICS, f"({_CORE['demographics_conversion']})",
         ["Group_By", "Group_Value", "Total_Customers", "Total_Purchases", "Conversion_Rate"]),
        (wording.CHAPTER_DRIVERS, wording.TABLE_CONVERSION, best,
         ["ProductName", "Avg_Price", "Unique_Customers", "Total_Purchases", "Conversion_Rate"]),
        ("", wording.TABLE_ENGAGEMENT, f"({_CORE['engagement_conversion']})",
         ["ContentType", "Total_Engagements", whole.format("Total_Purchases"), "Conversion_Rate"]),
        (wording.CHAPTER_SENTIMENT, wording.TABLE_SENTIMENT, f"({_CORE['sentiment_distribution']})",
         ["Category", "Percentage"]),
    ]
    fixed = ["=" * 60, "Customer & Marketing Analysis Report", "=" * 60]
    parts = []
    for chapter, caption, source, columns in tables:
        plain = ["Total_Purchases" if "CAST" in c else c.strip('"') for c in columns]
        fixed += ["", *([chapter, ""] if chapter else []), caption, " ".join(c.rjust(20) for c in plain)]
        parts.append(f"SELECT {_cells(*columns)} AS line FROM {source}")
    fixed += ["", wording.CHAPTER_CLOSING, ""]
    parts.append(f"SELECT line FROM ({_text_report_lines()})")
    parts.append(f"SELECT unnest([{', '.join(_text(line) for line in fixed)}]) AS line")
    return " UNION ALL ".join(parts)


# --- profiling ------------------------------------------------------------------------------------------------


def _per_column(template: str) -> str:
    """One SELECT per column of every raw table; ``{rows}`` is the table, ``{column}`` and ``{type}`` the column."""
    selects = []
    for name, schema in schemas.RAW.items():
        for field in schema:
            kind = field.dataType.simpleString()
            selects.append(
                f"SELECT '{name}' AS table_name, '{field.name}' AS column_name, "
                + template.format(column=field.name, type=kind)
                + f" FROM {_RAW[name]}"
            )
    return " UNION ALL ".join(selects)


def _duplicates() -> str:
    selects = []
    for name, schema in schemas.RAW.items():
        columns = ", ".join(field.name for field in schema)
        selects.append(
            f"SELECT '{name}' AS table_name, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates "
            f"FROM (SELECT count(*) AS n FROM {_RAW[name]} GROUP BY {columns})"
        )
    return " UNION ALL ".join(selects)


def _unique() -> str:
    selects = [
        f"SELECT '{name}' AS table_name, '{key}' AS column_name, "
        f"coalesce(max(n), 0) <= 1 AS is_unique, CAST(coalesce(sum(n) FILTER ({key} IS NULL), 0) AS BIGINT) AS nulls "
        f"FROM (SELECT {key}, count(*) AS n FROM {_RAW[name]} GROUP BY 1)"
        for name, key in schemas.PRIMARY_KEYS.items()
    ]
    return " UNION ALL ".join(selects)


def _value_counts(table: str, *columns: str) -> str:
    selects = [
        f"""SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS "count" FROM {table}
        WHERE {c} IS NOT NULL GROUP BY 2"""
        for c in columns
    ]
    return " UNION ALL ".join(selects)


_TYPE = """CASE WHEN bool_and(regexp_full_match(CAST({column} AS VARCHAR), '[+-]?[0-9]+')) THEN 'bigint'
  WHEN bool_and(regexp_full_match(CAST({column} AS VARCHAR), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')) THEN 'double'
  ELSE 'string' END AS type"""


def _clean_all() -> str:
    measures = {
        "customer_journey": ("round(sum(Duration * 100))", "Stage || Action"),
        "customer_reviews": ("sum(Rating)", "ReviewText"),
        "customers": ("sum(Age)", "Gender"),
        "engagement_data": ("sum(coalesce(Views, 0)) + sum(coalesce(Clicks, 0))", "ContentType"),
        "geography": ("sum(GeographyID)", "Country || City"),
        "products": ("round(sum(Price) * 100)", "ProductName"),
    }
    selects = [
        f"""SELECT '{name}' AS table_name, count(*) AS "rows", CAST(sum({schemas.PRIMARY_KEYS[name]}) AS BIGINT) AS keys,
        CAST({number} AS BIGINT) AS number, CAST(sum(length({words})) AS BIGINT) AS letters FROM {_CLEANED[name]}"""
        for name, (number, words) in measures.items()
    ]
    return " UNION ALL ".join(selects)


def _load_report() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, 'loaded' AS status, count(*) AS "rows" FROM {view}"""
        for name, view in _CLEANED.items()
    )


def _case_counts() -> str:
    cells = [
        ("Stage", "lower(Stage)", "raw_journey"),
        ("Action", "lower(Action)", "raw_journey"),
        ("ContentType", "upper(ContentType)", "raw_engagement"),
        ("Gender", "upper(substr(Gender, 1, 1)) || lower(substr(Gender, 2))", "raw_customers"),
    ]
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, {value} AS value, count(*) AS "rows" FROM {table} GROUP BY 2"""
        for name, value, table in cells
    )


def _load_versions() -> str:
    return """SELECT 'customer_journey' AS table_name, JourneyID AS key, Stage AS value FROM clean_journey
      UNION ALL SELECT 'products', ProductID, ProductName FROM clean_products WHERE Price > 1000"""


def _load_versions_report() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, 'loaded' AS status, count(*) AS "rows", 2::BIGINT AS version FROM {view}"""
        for name, view in _CLEANED.items()
    )


def _key_check() -> str:
    """Tables after those they name, each with the reason of every row."""
    faulty = {**_RAW, "customer_journey": "(SELECT * REPLACE (CASE WHEN JourneyID % 97 <> 0 THEN JourneyID END AS JourneyID) FROM raw_journey)"}
    views, selects = [], []
    for name in ("geography", "products", "customers", "customer_journey", "customer_reviews", "engagement_data"):
        key = schemas.PRIMARY_KEYS[name]
        reasons = [f"WHEN {key} IS NULL THEN 'no key'", f"WHEN count(*) OVER (PARTITION BY {key}) > 1 THEN 'repeated key'"]
        for column, table in schemas.FOREIGN_KEYS.get(name, {}).items():
            known = f"(SELECT {column} FROM told_{table} WHERE reason = 'good')"
            reasons.append(f"WHEN {column} IS NOT NULL AND {column} NOT IN {known} THEN 'no row in {table}'")
        views.append(f"told_{name} AS (SELECT *, CASE {' '.join(reasons)} ELSE 'good' END AS reason FROM {faulty[name]})")
        selects.append(
            f"""SELECT '{name}' AS table_name, reason, count(*) AS "rows", CAST(sum({key}) AS BIGINT) AS keys FROM told_{name} GROUP BY 2"""
        )
    return _sql(" UNION ALL ".join(selects), *views)


def _drawn(key: str = "CustomerID") -> str:
    return f"md5('7' || chr(31) || '0' || chr(31) || {key})"


def _sketch_check() -> str:
    selects = []
    for name in ("customer_journey", "customers", "products"):
        for field in schemas.RAW[name]:
            selects.append(
                f"""SELECT '{name}' AS table_name, '{field.name}' AS column_name, count(*) AS "rows",
                count(*) - count({field.name}) AS nulls, true AS close FROM {_RAW[name]}"""
            )
    return " UNION ALL ".join(selects)


def _correlations() -> str:
    names = ("Price", "Avg_Rating", "Review_Count", "Total_Purchases")
    pairs = " UNION ALL ".join(
        "SELECT '{}' AS column_name, {} FROM every".format(a, ", ".join(f"round(corr({a}, {b}), 6) AS {b}" for b in names)) for a in names
    )
    every = f"""every AS (
      SELECT CAST(Price AS DOUBLE) AS Price, Avg_Rating, Review_Count, Total_Purchases FROM products
      LEFT JOIN (SELECT ProductID, {_avg("Rating", 2)} AS Avg_Rating, count(ReviewID) AS Review_Count FROM {_RP} GROUP BY 1) USING (ProductID)
      LEFT JOIN (SELECT ProductID, {_count_where(_CHECKOUT_BUY)} AS Total_Purchases FROM {_JP} GROUP BY 1) USING (ProductID))"""
    return _sql(pairs, every)


def _retained(where: str) -> str:
    return f"""SELECT count(DISTINCT CustomerID) AS Total_Customers, {_count_where("visits > 1")} AS Retained_Customers,
      {_pct(_count_where("visits > 1"), "count(DISTINCT CustomerID)")} AS Retention_Rate
    FROM (SELECT CustomerID, count(DISTINCT VisitDate) AS visits FROM journey {where} GROUP BY 1)"""


_DATE = "CAST({0} AS VARCHAR) AS {0}"
_JOURNEY_COLUMNS = f"JourneyID, CustomerID, ProductID, {_DATE.format('VisitDate')}, Stage, Action, Duration"


#: the columns of the cleaned tables, dates as text and amounts as doubles
_COLUMNS = {
    name: ", ".join(
        {"date": _DATE, "decimal(10,2)": "CAST({0} AS DOUBLE) AS {0}"}.get(f.dataType.simpleString(), "{0}").format(f.name)
        for f in schema
    )
    for name, schema in schemas.CLEAN.items()
}


def _csv_rejects() -> str:
    """Good customers by id; bad lines as they stand in the file."""
    return """SELECT CASE WHEN fault = '' THEN 'loaded' ELSE 'rejected' END AS status,
      CASE WHEN fault = '' THEN CustomerID END AS CustomerID,
      CASE WHEN fault <> '' THEN line END AS bad_line
    FROM (SELECT CustomerID, fault,
        CASE WHEN fault = 'short' THEN CustomerID || ',' || CustomerName
        ELSE CASE WHEN fault = 'id' THEN 'A' ELSE '' END || CustomerID || ',' || CustomerName || ',' || Email || ',' || Gender || ','
          || CASE WHEN fault = 'age' THEN 'abc' ELSE Age::VARCHAR END || ','
          || CASE WHEN fault = 'place' THEN '1.5.2' ELSE GeographyID::VARCHAR END
          || CASE WHEN fault = 'long' THEN ',x' ELSE '' END END AS line
      FROM (SELECT *, CASE WHEN CustomerID % 17 = 0 THEN 'id' WHEN CustomerID % 19 = 0 THEN 'age' WHEN CustomerID % 23 = 0 THEN 'long'
        WHEN CustomerID % 29 = 0 THEN 'short' WHEN CustomerID % 31 = 0 THEN 'place' ELSE '' END AS fault FROM customers))"""


def statements() -> dict[str, str]:
    """The comparison SQL by query name."""
    core = {name: _sql(body) for name, body in _CORE.items()}
    rating_sentiment = "CASE WHEN Rating > 3 THEN 1 WHEN Rating = 3 THEN 0 ELSE -1 END"
    low_reviews = "(SELECT * FROM reviews WHERE Rating <= 2)"
    return {
        **core,
        "load_overwrite": _sql(f"SELECT {_JOURNEY_COLUMNS} FROM clean_journey", _CLEAN),
        "load_report": _sql(_load_report(), _CLEAN),
        "load_versions": _sql(_load_versions(), _CLEAN),
        "load_versions_report": _sql(_load_versions_report(), _CLEAN),
        "key_check": _key_check(),
        "profile_sample_rows": _sql(f"SELECT CustomerID, Gender, Age FROM customers ORDER BY {_drawn()} LIMIT 40"),
        "profile_sample_weighted": _sql(
            f"""SELECT CustomerID, Gender, Age FROM customers
            ORDER BY -ln((CAST('0x' || substr({_drawn()}, 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE)) / Age LIMIT 40"""
        ),
        "profile_sample_strata": _sql(
            f"SELECT CustomerID, Gender, Age FROM customers QUALIFY row_number() OVER (PARTITION BY Gender ORDER BY {_drawn()}) <= 7"
        ),
        "profile_sketch": _sql(_sketch_check()),
        "retention_by_month": _sql(
            """SELECT CAST(CAST(period AS DATE) AS VARCHAR) AS period, count(*) AS customers,
            CASE WHEN following IS NOT NULL THEN count(*) FILTER (again) END AS returning
            FROM (SELECT *, (CustomerID, following) IN (SELECT (CustomerID, period) FROM visited) AS again
              FROM visited JOIN (SELECT period, lead(period) OVER (ORDER BY period) AS following FROM (SELECT DISTINCT period FROM visited)) USING (period))
            GROUP BY period, following""",
            "visited AS (SELECT DISTINCT CustomerID, date_trunc('month', VisitDate) AS period FROM journey WHERE CustomerID IS NOT NULL)",
        ),
        "customers_over_days": _sql(f"SELECT count(DISTINCT CustomerID) AS customers FROM journey WHERE {_BUY}"),
        "correlation_matrix": _correlations(),
        "reviews_scored_csv": _sql(
            "SELECT ReviewID, ProductID, Rating, ReviewText, SentimentScore AS Sentiment FROM scored",
            _reviews_scored(
                """(SELECT CASE WHEN doc_id % 7 <> 0 THEN doc_id END AS ReviewID, doc_id % 200 AS ProductID,
                CAST(doc_id % 5 + 1 AS INTEGER) AS Rating, text AS ReviewText,
                unnest(CASE WHEN doc_id % 20 = 0 THEN [0, 1] ELSE [0] END) AS copied FROM documents)""",
                "ReviewID", "ProductID", "Rating", "ReviewText",
            ),
        ),
        "recs_text": _sql(f"SELECT line FROM ({_marketing()})"),
        "findings_text": _sql(_findings()),
        "text_report": _sql(_text_report()),
        "csv_rejects": _sql(_csv_rejects()),
        "clean_customers": _sql(f"SELECT {_COLUMNS['customers']} FROM clean_customers", _CLEAN),
        "clean_reviews": _sql(f"SELECT {_COLUMNS['customer_reviews']} FROM clean_reviews", _CLEAN),
        "clean_engagement": _sql(f"SELECT {_COLUMNS['engagement_data']} FROM clean_engagement", _CLEAN),
        "clean_geography": _sql("SELECT * FROM clean_geography", _CLEAN),
        "clean_products": _sql(f"SELECT {_COLUMNS['products']} FROM clean_products", _CLEAN),
        "sql_over_views": core["top_regions"],
        "profile_sample": _sql(
            """SELECT least(count(*), 6) AS drawn, least(count(*), 6) AS distinct_keys, least(count(*), 6) AS members FROM geography"""
        ),
        "clean_fill": _sql("SELECT JourneyID, coalesce(Duration, 0.0) AS Duration FROM raw_journey"),
        "clean_case": _sql(_case_counts()),
        "clean_strip": _sql(
            f"""SELECT ReviewID, CustomerID, ProductID, {_DATE.format("ReviewDate")}, Rating,
            trim(coalesce(ReviewText, 'No review'), ' ' || chr(9) || chr(10)) AS ReviewText FROM raw_reviews"""
        ),
        "clean_clip": _sql(
            """SELECT CustomerID, CASE WHEN Age < 18 THEN 18 WHEN Age > 100 THEN 100 ELSE Age END AS Age
            FROM raw_customers"""
        ),
        "clean_price_filter": _sql(
            "SELECT ProductID, ProductName, Category, CAST(Price AS DOUBLE) AS Price FROM raw_products WHERE Price > 0"
        ),
        "clean_distinct": _sql("SELECT DISTINCT GeographyID, Country, City FROM raw_geography"),
        "clean_dedup_key": _sql(
            """SELECT CustomerID, CustomerName, Email, Gender, Age, GeographyID FROM raw_customers
            QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY arrival) = 1"""
        ),
        "clean_split_pair": _sql(
            f"""SELECT EngagementID, ProductID,
            CASE WHEN {_PAIR} THEN CAST(split_part(ViewsClicksCombined, '-', 1) AS INTEGER) END AS Views,
            CASE WHEN {_PAIR} THEN CAST(split_part(ViewsClicksCombined, '-', 2) AS INTEGER) END AS Clicks
            FROM raw_engagement"""
        ),
        "clean_malformed_pairs": _sql(
            f"SELECT EngagementID, ViewsClicksCombined FROM raw_engagement WHERE NOT {_PAIR}"
        ),
        "clean_all": _sql(_clean_all(), _CLEAN),
        "profile_nulls": _sql(_per_column("count(*) - count({column}) AS nulls")),
        "profile_duplicates": _sql(_duplicates()),
        "profile_types": _sql(_per_column(_TYPE)),
        "profile_unique": _sql(_unique()),
        "profile_value_counts": _sql(
            _value_counts("raw_customers", "CustomerID", "CustomerName", "Email", "Gender", "Age", "GeographyID")
        ),
        "profile_rating_counts": _sql(_value_counts("reviews", "Rating")),
        "profile_info": _sql(_per_column("""'{type}' AS type, count(*) AS "rows", count({column}) AS non_null""")),
        "profile_head_tail": _sql(
            f"""(SELECT {_JOURNEY_COLUMNS}, 'head' AS part FROM journey ORDER BY JourneyID LIMIT 5) UNION ALL
            (SELECT {_JOURNEY_COLUMNS}, 'tail' AS part FROM journey ORDER BY JourneyID DESC LIMIT 10)"""
        ),
        "band_age": _sql(f"SELECT CustomerID, {_RANGES} AS Age_Range, {_GROUPS} AS age_group FROM customers"),
        "rating_sentiment": _sql(
            f"""SELECT ReviewID, ProductID, Rating, {rating_sentiment} AS Sentiment,
            CASE WHEN Rating > 3 THEN 'Positive' WHEN Rating = 3 THEN 'Neutral' ELSE 'Negative' END AS Category
            FROM reviews"""
        ),
        "join_integrated": _sql(
            f"SELECT {_JOURNEY_COLUMNS}, CustomerName, Gender, Age, GeographyID, Country, City FROM {_JCG}"
        ),
        "anti_top_products": _sql(
            f"""SELECT ProductID, ProductName, Category, CAST(Price AS DOUBLE) AS Price FROM products
            WHERE ProductID NOT IN (
              SELECT ProductID FROM journey WHERE {_BUY} GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)"""
        ),
        "checkout_retention": _sql(
            f"""SELECT CASE WHEN visits > 1 THEN 'Retained' ELSE 'One-Time' END AS Customer_Type, count(*) AS "Count"
            FROM (SELECT CustomerID, count(DISTINCT VisitDate) AS visits FROM journey WHERE {_CHECKOUT_BUY} GROUP BY 1)
            GROUP BY 1"""
        ),
        "geo_performance": _sql(
            f"""SELECT g.Country, g.City, {_DOUBLE.format("count(j.JourneyID)")} AS Purchases, {_avg("r.Rating")} AS AvgRating
            FROM geography g LEFT JOIN customers c ON g.GeographyID = c.GeographyID
            LEFT JOIN journey j ON c.CustomerID = j.CustomerID AND j.Action = 'purchase'
            LEFT JOIN reviews r ON j.ProductID = r.ProductID GROUP BY 1, 2"""
        ),
        "poorly_converting_products": _sql(
            f"""SELECT p.ProductName, {_DOUBLE.format("sum(e.Clicks)")} AS TotalClicks,
            {_DOUBLE.format("count(j.JourneyID)")} AS Purchases
            FROM products p LEFT JOIN engagement e ON p.ProductID = e.ProductID
            LEFT JOIN journey j ON p.ProductID = j.ProductID AND j.Action = 'purchase'
            GROUP BY 1 HAVING sum(e.Clicks) > 0 AND count(j.JourneyID) < 0.02 * sum(e.Clicks)"""
        ),
        "underperforming_channels": _sql(
            f"""SELECT ContentType, {_avg("Views")} AS AvgViews, {_avg("Clicks")} AS AvgClicks,
            {_DOUBLE.format("count(j.JourneyID)")} AS Purchases
            FROM engagement e LEFT JOIN journey j ON e.ProductID = j.ProductID AND j.Action = 'purchase'
            GROUP BY 1 HAVING count(j.JourneyID) / avg(Clicks) < 400"""
        ),
        "negative_reviews": _sql(
            f"SELECT ReviewID, ProductID, ProductName, ReviewText, Rating FROM {_RP} WHERE Rating <= 2"
        ),
        "retention_rate": _sql(_retained("")),
        "checkout_retention_rate": _sql(_retained(f"WHERE {_CHECKOUT_BUY}")),
        "one_time_purchasers": _sql(
            f"""SELECT CustomerID, count(DISTINCT JourneyID) AS PurchaseCount FROM {_JC} WHERE {_BUY}
            GROUP BY 1 HAVING count(DISTINCT JourneyID) = 1"""
        ),
        "top_channel_roi": _sql(
            f"SELECT ContentType, conversion_rate FROM {_best('channel_roi', 'conversion_rate', 'ContentType', 1)}"
        ),
        "top_converting_products": _sql(
            f"""SELECT ProductName, count(*) AS interactions, {_pct(_count_where(_BUY), "count(*)")} AS conversion_rate
            FROM {_JP} GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 5"""
        ),
        "demographic_performance": _sql(
            f"""SELECT {_GROUPS} AS age_group, Gender, Country, count(*) AS interactions,
            {_pct(_count_where(_BUY), "count(DISTINCT CustomerID)")} AS conversion_rate
            FROM {_JCG} GROUP BY 1, 2, 3 ORDER BY 5 DESC, 1, 2, 3 LIMIT 5"""
        ),
        "dropoff_rate": _sql(
            f"""SELECT Stage, count(*) AS Total_Visits, {_count_where("Action = 'drop-off'")} AS Dropoffs,
            {_pct(_count_where("Action = 'drop-off'"), "count(*)")} AS Dropoff_Rate FROM journey GROUP BY 1"""
        ),
        "dropoff_rate_ignoring_case": _sql(
            f"""SELECT lower(Stage) AS Stage, count(*) AS Total_Visits,
            {_count_where("lower(Action) = 'drop-off'")} AS Dropoffs,
            {_pct(_count_where("lower(Action) = 'drop-off'"), "count(*)")} AS Dropoff_Rate FROM raw_journey GROUP BY 1"""
        ),
        "dropoff_counts": _sql(
            "SELECT Stage, count(*) AS DropOffCount FROM journey WHERE Action = 'drop-off' GROUP BY 1"
        ),
        "avg_stage_duration": _sql(
            """SELECT Stage, count(*) AS Total_Visits, round(avg(Duration), 2) AS Avg_Duration_Seconds
            FROM journey WHERE Duration IS NOT NULL GROUP BY 1"""
        ),
        "avg_stage_duration_filled": _sql(
            """SELECT Stage, count(*) AS Total_Visits, round(avg(coalesce(Duration, 0.0)), 2) AS Avg_Duration_Seconds
            FROM journey GROUP BY 1"""
        ),
        "highest_rated_products": _sql(
            f"SELECT ProductID, ProductName, {_avg('Rating')} AS AvgRating FROM {_RP} GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 5"
        ),
        "top_rated_by_name": _sql(
            f"SELECT ProductName, {_avg('Rating', 1)} AS AvgRating FROM {_RP} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"
        ),
        "top_rated_ids": _sql(
            f"SELECT ProductID, {_avg('Rating')} AS AvgRating FROM reviews GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"
        ),
        "lowest_rated_ids": _sql(
            f"""SELECT ProductID, {_avg("Rating")} AS AvgRating, count(*) AS ReviewCount FROM reviews
            GROUP BY 1 ORDER BY 2 NULLS FIRST, 1 LIMIT 5"""
        ),
        "reviews_per_product": _sql(
            f"""SELECT ProductID, ProductName, count(ReviewID) AS ReviewCount, {_avg("Rating")} AS AvgRating
            FROM {_RP} GROUP BY 1, 2"""
        ),
        "product_ratings": _sql(
            f"""SELECT ProductID, ProductName, {_avg("Rating", 2)} AS Avg_Rating, count(ReviewID) AS Review_Count
            FROM {_RP} GROUP BY 1, 2"""
        ),
        "product_purchases": _sql(
            f"SELECT ProductID, ProductName, {_count_where(_CHECKOUT_BUY)} AS Total_Purchases FROM {_JP} GROUP BY 1, 2"
        ),
        "rating_purchase_corr": _sql(
            f"""SELECT count(*) AS products, round(corr(Avg_Rating, Total_Purchases), 6) AS correlation
            FROM (SELECT ProductID, ProductName, {_avg("Rating", 2)} AS Avg_Rating FROM {_RP} GROUP BY 1, 2)
            JOIN (SELECT ProductID, ProductName, {_count_where(_CHECKOUT_BUY)} AS Total_Purchases FROM {_JP} GROUP BY 1, 2)
            USING (ProductID, ProductName)"""
        ),
        "regional_product_sales": _sql(
            f"""SELECT Country, ProductName, count(*) AS SalesCount FROM {_JCG} JOIN products USING (ProductID)
            WHERE {_BUY} GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10"""
        ),
        "journey_geography": _sql(
            f"""SELECT CustomerID, Country, City, Stage, Action, CAST(VisitDate AS VARCHAR) AS VisitDate
            FROM {_JCG} ORDER BY JourneyID LIMIT 10"""
        ),
        "rating_vs_engagement": _sql(
            f"""SELECT r.ProductID, {_avg("Rating", 1)} AS AvgRating, {_DOUBLE.format("sum(Views)")} AS TotalViews,
            {_DOUBLE.format("sum(Clicks)")} AS TotalClicks
            FROM reviews r JOIN engagement e ON r.ProductID = e.ProductID GROUP BY 1"""
        ),
        "sentiment_summary": _sql(
            f"""SELECT CASE WHEN Rating <= 2 THEN 'Negative' WHEN Rating = 3 THEN 'Neutral' ELSE 'Positive' END AS Sentiment,
            count(*) AS Total_Reviews, {_avg("Rating", 2)} AS Avg_Rating FROM {_RP} GROUP BY 1"""
        ),
        "engagement_likes": _sql(
            f"""SELECT ContentType, count(DISTINCT EngagementID) AS Total_Engagements,
            {_DOUBLE.format("sum(Likes)")} AS Total_Likes, {_DOUBLE.format(_count_where(_CHECKOUT_BUY))} AS Total_Purchases,
            {_pct(_count_where(_CHECKOUT_BUY), "count(DISTINCT EngagementID)")} AS Conversion_Rate
            FROM engagement e LEFT JOIN journey j ON e.ProductID = j.ProductID GROUP BY 1"""
        ),
        "text_polarity": _sql("SELECT * FROM scored", _reviews_scored(_DOCUMENTS, "ReviewID")),
        "text_sentiment_class": _sql(
            """SELECT *, CASE WHEN SentimentScore > 0 THEN 'Positive' WHEN SentimentScore < 0 THEN 'Negative'
            ELSE 'Neutral' END AS SentimentCategory FROM scored""",
            _reviews_scored(_DOCUMENTS, "ReviewID"),
        ),
        "negative_polarity_gate": _sql(
            _gate(), _reviews_scored(f"(SELECT * FROM {_RATED_DOCUMENTS} WHERE Rating <= 2)", "ReviewID")
        ),
        "negative_polarity_gate_open": _sql(
            _gate("0.9"), _reviews_scored(f"(SELECT * FROM {_RATED_DOCUMENTS} WHERE Rating <= 2)", "ReviewID")
        ),
        "text_polarity_in_order": _sql(
            """SELECT *, CASE WHEN SentimentScore > 0 THEN 'Positive' WHEN SentimentScore < 0 THEN 'Negative'
            ELSE 'Neutral' END AS SentimentCategory FROM scored""",
            _scored_in_order(_DOCUMENTS, "ReviewID"),
        ),
        "scored_reviews_in_order": _sql(
            "SELECT ReviewID, Rating, ReviewText, SentimentScore AS Sentiment FROM scored",
            _scored_in_order("raw_reviews", "ReviewID", "Rating", "ReviewText"),
        ),
        "negative_polarity_gate_in_order": _sql(_gate("-0.1"), _scored_in_order(low_reviews, "ReviewID")),
        "recs_strategic": _sql(_strategic()),
        "recs_marketing": _sql(_marketing()),
        "recs_experience": _sql(_experience(), _reviews_scored(low_reviews, "ReviewID")),
        "recs_business": _sql(_business()),
        "recs_text_report": _sql(_text_report_lines()),
    }
