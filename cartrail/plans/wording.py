"""The wording of the recommendation lines, which has to read the same in every report.

``%s`` is filled by Spark's ``format_string``.
"""

# strategic report
TOP_CONVERTING = "Focus marketing on top converting products: %s."
BEST_CONTENT = "Prioritize %s content, as it shows the highest engagement conversion."
BEST_AGE = "Target customers in the age group %s, who demonstrate the highest conversion rate."
NEGATIVE_PRODUCTS = "Address negative reviews for products: %s."
CHECKOUT = "Improve the checkout process to reduce high drop-off rates and increase conversions."

# marketing report
IMPROVE_PRODUCT = "Consider improving or marketing %s (Rating: %s, Sales: %s)."
BOOST_CHANNEL = "Boost marketing in %s campaigns (Avg Views: %s, Avg Clicks: %s, Purchases: %s)."

# customer-experience report
DISSATISFIED = (
    "Customer sentiment analysis indicates dissatisfaction. "
    "Address common complaints and improve product quality."
)
LOWEST_HEADER = "The following products have the lowest ratings and need quality improvement:"
LOWEST_ITEM = "- %s (Product ID: %s): Avg Rating %s (Reviews: %s)"
ONE_TIME = (
    "%s customers made only one purchase. Consider implementing loyalty rewards "
    "or personalized follow-ups to increase retention."
)
COMPLAINT_HEADER = "Top recurring customer complaints:"
COMPLAINT_ITEM = "- %s (Product: %s | Mentioned %s times)"

# business report
FLAGSHIP = "Promote **%s** as the flagship product (Conversion rate: %s%%)."
DEMOGRAPHIC = "Focus marketing on **%s %ss** in **%s** (Conversion rate: %s%%)."
REGION = "Prioritize **%s** in **%s** (Sales: %s units)."
CHANNEL = "Increase budget for **%s** campaigns (Conversion rate: %s%%)."
DISCOUNT = "Introduce discounts for **%s** (Rating: %s/5, Reviews: %s)."
NO_DISCOUNT = "No discount candidates identified – maintain current pricing strategy."

# text report: chapters, captions of its tables, closing lines
CHAPTER_TRENDS = "1. Customer Trends"
CHAPTER_SEGMENTS = "2. Segment Performance"
CHAPTER_DRIVERS = "3. Key Purchase Drivers"
CHAPTER_SENTIMENT = "4. Customer Sentiment Analysis"
CHAPTER_CLOSING = "5. Strategic Recommendations"
TABLE_PRODUCTS = "Top 5 Products by Engagement:"
TABLE_REGIONS = "Top 5 Regions by Sales:"
TABLE_RETENTION = "Customer Retention:"
TABLE_DEMOGRAPHICS = "Conversion Rates by Demographic:"
TABLE_CONVERSION = "Top Performing Products:"
TABLE_ENGAGEMENT = "Engagement Effectiveness:"
TABLE_SENTIMENT = "Sentiment Distribution (%):"
REPORT_AGE = "- Target customers aged %s in %s (highest conversion rates)"
REPORT_TOP = "- Focus marketing on top converting products: %s"
REPORT_CONTENT = "- Prioritize %s content (highest engagement conversion)"
REPORT_CHECKOUT = "- Improve checkout process for products with high drop-off rates"
REPORT_NEGATIVE = "- Address negative reviews for: %s"

# findings
DROP_OFF_HEADER = "Customer Journey Drop-off Points:"
DROP_OFF_ITEM = "%s: %s drop-offs"
RATED_HEADER = "Highest Rated Products:"
RATED_ITEM = "Product ID %s: Average Rating %s"
