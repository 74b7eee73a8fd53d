"""DuckDB text of the adapter tables, for the oracle statements."""

ACCOUNT = 4242424242

EV = """ev AS (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k, CAST(ts AS DATE) AS day FROM events)"""

VISITS = EV + f""",
v0 AS (SELECT user_id, day, min(ts) AS start_ts, arg_min(k, event_id + epoch_us(ts)::HUGEINT * 1000000000) AS fk,
         count(*) AS totalHits FROM ev GROUP BY ALL),
visits AS (SELECT user_id, day, fk, totalHits, CAST(user_id AS VARCHAR) AS fullVisitorId,
  row_number() OVER (PARTITION BY user_id ORDER BY day) AS visitNumber,
  epoch_us(start_ts) // 1000000 AS visitStartTime, epoch_us(start_ts) // 1000000 AS visitId,
  strftime(day, '%Y%m%d') AS shard,
  ['mobile','desktop','tablet'][user_id % 3 + 1] AS deviceCategory,
  ['United States','Canada','Israel','Mexico'][user_id % 4 + 1] AS country, 'R' || user_id % 6 AS region,
  ['google','Bing','facebook','newsletter','(direct)'][fk % 5 + 1] AS source,
  ['cpc','organic','email'][fk % 3 + 1] AS medium,
  [NULL,'shopbrand core','au pla','discovery contact','conta private lab','HTO trial','cart abn'][fk % 7 + 1] AS campaign,
  'kw' || fk % 4 AS keyword, CASE WHEN fk % 6 <> 0 THEN 'ad' || fk % 6 END AS adContent,
  CASE WHEN fk % 2 = 1 THEN {ACCOUNT} END AS customerId, CAST(1000 + fk % 10 AS BIGINT) AS adGroupId,
  CASE WHEN totalHits = 1 THEN 1 END AS bounces, 'V' || user_id AS visitorKey,
  CASE WHEN user_id % 5 <> 0 THEN md5(CASE WHEN user_id % 4 = 2 THEN 'U' ELSE 'u' END || user_id || '@x') END AS hashedEmail
  FROM v0)"""

HITS = VISITS + """,
hits AS (SELECT v.*, e.event_id, e.k, e.event_type, e.value, e.ts,
  row_number() OVER (PARTITION BY e.user_id, e.day ORDER BY e.ts, e.event_id) AS hitNumber,
  epoch_us(e.ts) // 1000 - v.visitStartTime * 1000 AS time,
  CASE WHEN event_type = 'view' THEN 'PAGE' ELSE 'EVENT' END AS type,
  CASE WHEN event_type = 'view' AND k % 3 = 0 OR event_type = 'click' AND k % 4 = 0
         THEN '/p/' || lpad(CAST(k AS VARCHAR), 2, '0') || '-item?x=' || k
       WHEN event_type = 'view' AND k % 3 = 1 AND k % 4 = 0 THEN '/c/designer-glasses?x=' || k
       WHEN event_type = 'view' AND k % 3 = 1 THEN '/c/all?x=' || k
       WHEN event_type = 'view' THEN '/cms/' || k || '?x=' || k
       WHEN event_type = 'click' AND k % 8 = 2 THEN '/checkout/cart?x=' || k
       WHEN event_type = 'click' AND k % 8 = 6 THEN '/checkout/onepage?x=' || k
       WHEN event_type = 'click' THEN '/cms/' || k
       WHEN event_type = 'signup' THEN '/account/' || k
       WHEN event_type = 'purchase' THEN '/checkout/success?x=' || k
       WHEN k % 2 = 0 THEN '/home' ELSE '/mini/' || k % 5 || '?x=' || k END AS pagePath,
  CASE WHEN event_type = 'error' AND k % 2 = 1 THEN 'minipage.shop' ELSE 'www.shop' END AS hostname,
  CASE event_type WHEN 'view' THEN CASE WHEN k % 15 = 10 THEN 'Category - all' END
       WHEN 'click' THEN CASE WHEN k % 2 = 0 THEN 'EEC' ELSE 'popups' END
       WHEN 'signup' THEN CASE WHEN k < 50 THEN 'popups' ELSE 'Newsletter Registration' END
       WHEN 'error' THEN CASE WHEN k % 2 = 0 THEN 'HP' ELSE 'Shop Marketing LP' END END AS eventCategory,
  CASE event_type WHEN 'view' THEN CASE WHEN k % 15 = 10 THEN 'Filter - Brand' END
       WHEN 'click' THEN CASE WHEN k % 2 = 0 THEN 'Cart' ELSE 'Popup' END
       WHEN 'signup' THEN CASE WHEN k < 50 THEN 'Popup' WHEN k % 10 = 9 THEN 'Newsletter subscription' ELSE 'User Subscribed' END
       WHEN 'error' THEN CASE WHEN k % 4 = 0 THEN 'HP Banner Impression' WHEN k % 2 = 0 THEN 'HP Banner Click'
            ELSE ['CTA Click','Product Click','Logo Click','Footer Click color'][(k % 8) // 2 + 1] END END AS eventAction,
  CASE event_type WHEN 'view' THEN CASE WHEN k % 15 = 10 THEN CASE WHEN k % 2 = 0 THEN 'Open' ELSE 'Brand X' END END
       WHEN 'click' THEN CASE WHEN k % 4 = 0 THEN 'AddToCart' WHEN k % 4 = 2 THEN 'Products'
            ELSE ['sms-popup-Show','nl-popup-Showed','nl-popup-reminder-show','subscribed-popup-showed','ty-popup-showed'][(k % 10) // 2 + 1] END
       WHEN 'signup' THEN CASE WHEN k < 50 THEN CASE WHEN k % 2 = 1 THEN 'sms-popup-subscribe'
              WHEN k % 10 = 8 THEN 'nl-popup-subscribe-error' ELSE 'nl-popup-subscribe' END
            WHEN k % 10 = 9 THEN 'success' ELSE ['One Tap','checkout','account','footer'][k % 4 + 1] END
       WHEN 'error' THEN CASE WHEN k % 2 = 0 THEN 'Slide ' || k % 3 WHEN k % 5 = 0 THEN 'v2 block' ELSE 'block ' || k % 3 END
       END AS eventLabel,
  CASE WHEN event_type = 'view' AND k % 3 = 0 THEN '2' WHEN event_type = 'click' AND k % 4 = 0 THEN '3'
       WHEN event_type = 'purchase' THEN '6' END AS actionType,
  CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) END AS transactionId,
  CASE WHEN event_type = 'purchase' THEN CAST(round(value * 1000000) AS BIGINT) END AS transactionRevenue,
  CASE WHEN event_type = 'purchase' THEN CASE WHEN k % 3 = 0 THEN '1' ELSE '0' END END AS isTrial,
  CASE WHEN event_type = 'view' THEN ['PRODUCT','CATEGORY','CMS'][k % 3 + 1] END AS pageKind
  FROM ev e JOIN visits v USING (user_id, day))"""

PRODUCTS = HITS + """,
products AS (SELECT h.*, CAST(p_partkey % 90 + 10 AS VARCHAR) || '-' || p_partkey AS productSKU, p_brand AS productBrand,
  CAST(round(p_retailprice * 1000000) AS BIGINT) AS productPrice,
  ['Progressive','Single Vision','Bifocal'][p_size % 3 + 1] AS lens, CAST(p_size % 2 AS VARCHAR) AS isPremium,
  CASE p_size % 5 WHEN 0 THEN 'Contacts' WHEN 1 THEN 'Accessories'
       ELSE CASE WHEN p_size % 10 = 7 THEN 'upgrade' ELSE 'Glasses' END END AS eyewearType
  FROM (SELECT *, unnest(range(0, k % 3 + 1)) AS i FROM hits WHERE actionType IS NOT NULL OR eventLabel = 'Products') h
  JOIN part ON p_partkey = (event_id * 31 + i * 17) % (SELECT max(p_partkey) + 1 FROM part))"""

MEDIA_CTE = """,
mref AS (SELECT source, medium, campaign, adwords_account,
    CASE WHEN campaign = 'cart abn' THEN 'Newsletter Abn' ELSE source || ' ' || medium END AS Media
  FROM (SELECT lower(source) AS source, lower(medium) AS medium, lower(campaign) AS campaign, customerId AS adwords_account,
          min(fk) AS mfk FROM visits GROUP BY ALL) WHERE mfk % 5 <> 4 OR mfk % 3 = 0),
mtype AS (SELECT DISTINCT Media, upper(left(Media, 2)) AS Platform,
    CASE WHEN Media LIKE '%organic' THEN 'Organic' ELSE 'Paid' END AS media_name_group,
    CASE WHEN Media LIKE 'g%' THEN 'Contact Lenses' ELSE 'Glasses' END AS Product_Type FROM mref),
hm AS (SELECT h.*, r.Media FROM hits h LEFT JOIN mref r ON lower(h.source) = r.source AND lower(h.medium) = r.medium
    AND lower(h.campaign) IS NOT DISTINCT FROM r.campaign AND h.customerId IS NOT DISTINCT FROM r.adwords_account)"""

MEDIA = HITS + MEDIA_CTE

PAGE_TYPE = """CASE WHEN {0} IS NULL THEN NULL WHEN contains({0}, 'checkout') THEN 'Checkout' WHEN contains({0}, '/p/') THEN 'Product'
  WHEN contains({0}, '/c/') THEN 'Category' WHEN contains({0}, '/mini/') THEN 'Mini' ELSE 'Other' END"""

PATH = "split_part({0}, '?', 1)"


def page_type(col: str) -> str:
    """Page type of the path part of a column."""
    return PAGE_TYPE.format(PATH.format(col))

EMAIL = "CASE WHEN o_custkey % 97 = 5 THEN '' ELSE CASE WHEN o_custkey % 2 = 0 THEN 'U' ELSE 'u' END || o_custkey || '@x' END"

ITEMS = f"""items AS (SELECT o_orderkey AS Order_Number, o_custkey, o_orderdate + to_minutes(o_orderkey % 1440) AS Creation_Datetime,
  {EMAIL} AS customer_email,
  CASE p_size % 5 WHEN 0 THEN 'Contact Lenses' WHEN 1 THEN CASE WHEN p_size % 2 = 0 THEN 'Accessories' ELSE 'Product Upgrade' END ELSE 'Eyeglasses' END AS EyewearType,
  CASE WHEN p_size % 5 = 0 THEN 'Contact Lenses' ELSE p_type END AS FrameType,
  ['Progressive','Single Vision','Bifocal'][p_size % 3 + 1] AS LensType, p_brand AS brand, p_name AS Item_Name,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Main' ELSE 'AU' END AS Store, ['mobile','desktop','tablet'][o_orderkey % 3 + 1] AS Device,
  CASE o_orderkey % 10 WHEN 0 THEN NULL WHEN 1 THEN 'TEST100x' WHEN 2 THEN 'Trial1' ELSE 'SAVE' || o_orderkey % 3 END AS Order_Coupon,
  CASE o_custkey % 4 WHEN 0 THEN 'code-batchA-' || o_custkey % 7 WHEN 1 THEN 'code-other-' || o_custkey % 7 END AS affiliate_code,
  CAST(p_partkey % 90 + 10 AS VARCHAR) || '-' || p_partkey AS FinalShortSKU,
  CASE WHEN o_orderkey % 3 = 0 THEN 'New' ELSE 'Returning' END AS New_Returning,
  l_quantity AS Item_Qty_Ordered, l_extendedprice AS Item_Price, l_extendedprice * (1 - l_discount) AS ItemRevenue,
  l_extendedprice * (1 - l_discount) * l_tax AS Item_Tax, o_totalprice AS Order_SubTotal,
  l_extendedprice * l_discount * 0.1 AS Item_Gift_Certificate_Amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

MAIL = EV + """,
mailev AS (SELECT *, CASE WHEN user_id % 2 = 0 THEN 'U' ELSE 'u' END || user_id || '@x' AS mail,
    CASE WHEN event_id % 50 <> 7 THEN CASE WHEN user_id % 2 = 0 THEN 'U' ELSE 'u' END || user_id || '@x' END AS email,
    ((day(ts) - 1) // 5 * 5 + 1) || '.' || month(ts) || '.24_c' || k % 4 AS message_name, 'm' || k % 4 AS msID FROM ev),
tz AS (SELECT DISTINCT day AS Date, CASE WHEN day(day) % 2 = 0 THEN -8 ELSE -7 END AS pst FROM ev),
asent AS (SELECT ts, email, 'message-sent' AS action, message_name, 'd' || k % 2 AS mdtID, msID, 'e' || k % 2 AS experiment,
    'v' || k % 3 AS variant, CASE WHEN k % 3 <> 0 THEN '["t' || k % 2 || '"]' END AS mTags FROM mailev WHERE event_type = 'view'),
act AS (SELECT ts, email, message_name, msID, CASE event_type WHEN 'error' THEN 'open' WHEN 'click' THEN 'click'
      ELSE CASE WHEN k < 50 THEN 'optout' ELSE 'bounce' END END AS action,
    CASE WHEN k % 5 <> 0 THEN '/l/' || k % 5 END AS link, 'n' || k % 5 AS linkname, ['mobile','desktop'][k % 2 + 1] AS Device,
    'os' || k % 3 AS Device_OS FROM mailev WHERE event_type IN ('error', 'click', 'signup'))"""

EORD = """eord AS (SELECT event_id AS Order_Number, ts AS Creation_Datetime, 'u' || user_id || '@x' AS customer_email,
    CASE WHEN k % 5 = 0 THEN 'Contact Lenses' ELSE 'Eyeglasses' END AS EyewearType,
    CASE WHEN k % 5 = 0 THEN 'Contact Lenses' ELSE 'Frame' || k % 3 END AS FrameType,
    ['Progressive','Single Vision','Bifocal'][k % 3 + 1] AS LensType,
    CASE WHEN k % 4 <> 0 THEN 'C' || k % 4 END AS Order_Coupon, value AS ItemRevenue, CAST(1 AS DOUBLE) AS Item_Qty_Ordered,
    CASE WHEN k % 3 = 0 THEN 'New' ELSE 'Returning' END AS New_Returning,
    ['Newsletter Other','Google Brand','cordial newsletter'][k % 3 + 1] AS media FROM ev WHERE event_type = 'purchase'),
ecl AS (SELECT mail AS EmailAddress, ts - to_hours(k % 24) AS DeliveryDate, ts AS ActionDateTime, message_name AS MessageName,
    CASE WHEN k % 5 <> 0 THEN '/l/' || k % 5 END AS linkUrl, 'n' || k % 5 AS linkname, ['mobile','desktop'][k % 2 + 1] AS Device,
    CASE WHEN k % 3 <> 0 THEN '["t' || k % 2 || '"]' ELSE '["None"]' END AS mTags, 'o' || k % 2 AS noOfOrders
    FROM mailev WHERE event_type = 'click')"""
