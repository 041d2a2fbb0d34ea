"""Fixed values of the review domain.

Every value below is fixed: results only match when it is used exactly as
written (names, order, patterns, thresholds, texts).
"""

# --- aspects and sentiments (fixed values, fixed order) ---------------------
ASPECTS = ["description", "quality", "packaging", "delivery", "service", "price"]
SENTIMENTS = ["positive", "neutral", "negative"]
LABEL_CODES = {"negative": 0, "neutral": 1, "positive": 2}
SHORT = {"positive": "pos", "neutral": "neu", "negative": "neg"}

# Aspect names inside retrieval documents (fixed values).
ASPECT_DOC_NAMES = {
    "description": "mô tả",
    "quality": "chất lượng",
    "packaging": "đóng gói",
    "delivery": "giao hàng",
    "service": "dịch vụ",
    "price": "giá cả",
}
# Aspect names inside reports and search contexts (fixed values).
ASPECT_REPORT_NAMES = {
    "description": "Mô tả SP",
    "quality": "Chất lượng",
    "packaging": "Đóng gói",
    "delivery": "Giao hàng",
    "service": "Dịch vụ",
    "price": "Giá cả",
}

# --- thresholds (fixed values) ----------------------------------------------
MIN_REVIEWS = 1
LOOKBACK_DAYS = 15
REVIEWS_PER_PAGE = 20
FAST_REVIEW_PAGES = 5
CHUNK_SIZE = 5000
RERANK_WEIGHT = 0.15
MAX_HISTORY = 8
REWRITE_HISTORY = 6
RETRAIN_VOLUME = 250
BASELINE_F1 = 0.848
F1_DROP = 0.95
MIN_INTERACTIONS = 10
TOKENS_IN, TOKENS_OUT = 150, 80
USD_IN, USD_OUT = 0.075, 0.30
SMOKE_MIN_HITS = 3

# --- text cleaning (fixed values, rules apply in this order) ----------------
ABBREVIATIONS = [
    ("sp", "sản phẩm"),
    ("ksd", "không sử dụng"),
    ("tks|thanks", "cảm ơn"),
    ("đc", "được"),
    ("clg", "chất lượng"),
    ("hđ", "hướng dẫn"),
    ("nv", "nhân viên"),
    ("ko|k", "không"),
    ("j", "gì"),
    ("ship", "giao hàng"),
    ("re", "rẻ"),
    ("tl", "trả lời"),
    ("vs", "với"),
]
VIETNAMESE_LETTERS = (
    "àáạảãâầấậẩẫăằắặẳẵèéẹẻẽêềếệểễìíịỉĩòóọỏõôồốộổỗơờớợởỡùúụủũưừứựửữỳýỵỷỹđ"
)
BOILERPLATE = [
    "liên hệ shop",
    "hình ảnh mang tính minh họa",
    "vui lòng liên hệ",
    "shop cam kết",
]
# Unicode white space as one explicit character class body; reads the same in
# Java and RE2 regular expressions.
WS = (
    r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The same characters as a plain string, for trimming.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
)
WORD = r"\p{L}\p{N}_"

# --- catalogue detail columns (fixed values) --------------------------------
DETAIL_FIELDS = [
    "product_id", "name", "short_name", "sku", "price", "list_price",
    "discount", "discount_rate", "rating_average", "review_count",
    "order_count", "favourite_count", "thumbnail_url", "brand_name",
    "brand_id", "seller_name", "seller_id", "seller_sku", "category_name",
    "category_id", "short_description", "specifications", "inventory_status",
    "stock_item_qty", "stock_item_max_sale_qty", "has_ebook", "is_fresh",
    "is_genuine", "url_path", "product_url", "ai_review_summary",
]
DETAIL_KEEP = [
    "product_id", "sku", "name", "brand_id", "brand_name", "category_id",
    "category_name", "price", "list_price", "discount", "discount_rate",
    "short_description", "specifications", "seller_id", "seller_sku",
    "seller_name", "inventory_status", "thumbnail_url", "product_url",
    "url_path", "rating_average", "review_count",
]
DETAIL_RENAME = {
    "rating_average": "rating_from_detail",
    "review_count": "review_count_from_detail",
}
FINAL_COLUMNS = [
    "product_id", "customer_name", "rating", "content", "created_at",
    "clean_content", "tokens",
]
DEDUP_COLUMNS = ["product_id", "customer_name", "rating", "content"]

# --- chat rules (fixed values) ----------------------------------------------
FOLLOWUP_HINTS = [
    "sản phẩm này", "sp này", "món này", "cái này", "hàng này", "nó",
    "link vừa gửi", "link mới gửi", "sản phẩm vừa gửi", "sản phẩm mới gửi",
    "mới gửi", "vừa gửi",
]
ALTERNATIVE_HINTS = [
    "thay thế", "sản phẩm khác", "sp khác", "mẫu khác", "món khác",
    "tương tự", "cùng phân khúc", "alternative", "so sánh với",
]
PURCHASE_HINTS = [
    "có nên mua", "nên mua không", "đáng mua", "đáng tiền", "ổn không",
    "ok không", "có tốt không",
]
REVIEW_HINTS = [
    "người dùng nói gì", "khách nói gì", "review", "đánh giá", "nhận xét",
    "phàn nàn", "ưu điểm", "nhược điểm", "vấn đề lớn nhất", "điểm yếu",
    "điểm mạnh",
]
# Intent name -> hints, first match wins.
INTENTS = [
    ("alternative_recommendation", ALTERNATIVE_HINTS),
    ("purchase_advice", PURCHASE_HINTS),
    ("review_summary", REVIEW_HINTS),
]
SHORTENED_MARK = "\n...[đã rút gọn]"
USER_CHARS, ASSISTANT_CHARS, PRODUCT_CONTEXT_CHARS = 1200, 2500, 3500
REMEMBER_TEXT = (
    "Ghi nhớ ngữ cảnh hội thoại hiện tại. "
    "Các cụm như 'sản phẩm này', 'sp này', 'cái này', 'nó', "
    "'sản phẩm mới gửi', 'sản phẩm vừa gửi', 'link vừa gửi' "
    "đều ám chỉ sản phẩm dưới đây:\n\n"
)
# Warm-up query templates and fixed queries (fixed values).
BRAND_TEMPLATES = ["sản phẩm %s tốt nhất", "%s giá rẻ"]
CATEGORY_TEMPLATES = ["%s chất lượng tốt", "%s giá rẻ", "%s được đánh giá cao"]
WARM_QUERIES = [
    "cốc giữ nhiệt tốt",
    "bình giữ nhiệt Lock&Lock",
    "đồ gia dụng dưới 300k",
    "sản phẩm giao hàng nhanh",
    "chảo chống dính tốt nhất",
    "pin tiểu chính hãng",
    "bình nước inox",
    "nồi chiên không dầu",
    "sản phẩm chất lượng cao",
    "sản phẩm được đánh giá tốt",
    "sản phẩm dưới 100k",
    "sản phẩm dưới 200k",
    "sản phẩm dưới 500k",
]
# URL name space of RFC 4122, as hex digits.
UUID_URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
