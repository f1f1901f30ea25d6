"""Word lists and patterns of the phone-review domain.

Operators take them as arguments; other domains pass their own.
"""

# --- Fixed values: results depend on them word for word ---------------------

# Words dropped from comments.
COMMENT_STOPWORDS = ["근데", "진짜", "진쨔", "진짜루", "진짜로", "진쨔루"]

# Noun tokens dropped after extraction.
NOUN_STOPWORDS = ["중", "하기", "되기", "임", "됨"]

# Terms that tie a sentence to the first brand.
APPLE_TERMS = [
    "갤럭시",
    "ios", "m1", "m2", "애플 실리콘",
    "페이스 id", "faceid", "페이스 아이디", "페이스아이디", "트루뎁스",
    "icloud", "아이클라우드", "에어드롭", "에어드랍",
    "맥세이프", "magsafe", "다이나믹 아일랜드",
    "애플페이", "애플 페이", "애플 월렛",
    "시리", "siri", "뉴럴 엔진",
    "애플케어",
    "애플 뮤직",
    "라이트닝",
]

# Terms that tie a sentence to the second brand.
SAMSUNG_TERMS = [
    "아이폰",
    "안드로이드", "엑시노스", "액시노스", "스냅드래곤",
    "초음파",
    "아몰레드", "amoled", "고릴라 글래스", "폴더블", "폴더블폰",
    "s펜", "spen", "s pen",
    "삼성 페이", "삼페", "삼성페이", "삼성 월렛",
    "빅스비",
    "삼성 헬스",
    "방수방진", "빅터스",
    "dex",
    "굿락", "good lock",
    "s시리즈", "갤럭시", "겔럭시", "삼성",
]

# Model spellings, tried in this order at the start of a word.
SAMSUNG_PATTERNS = [
    r"s\d+\+?", r"갤럭시s\d+", r"갤\d+", r"\d+플러스", r"\d+울트라", r"갤\d+울트라",
    r"울트라", r"삼성폰", r"갤럭시폰", r"fe", r"\d+플립", r"갤\d+플립", r"플립",
    r"노트\d+", r"갤노트\d+", r"노트", r"\d+폴드", r"갤\d+폴드", r"폴드", r"z폴드",
]
IPHONE_PATTERNS = [
    r"\d{2}pro(max)?", r"\d{2}프맥", r"프맥\d{2}", r"프맥", r"아이폰\d+", r"미니", r"se",
    r"pro(max)?", r"프로맥스", r"프로", r"맥스", r"아이폰프로맥스",
]
SAMSUNG_NAME = "갤럭시"
IPHONE_NAME = "아이폰"
NAME_FIXUPS = [("갤럭시+", "갤럭시")]

# Characters kept by the special-character filter.
KEPT_CHARACTERS = "가-힣a-zA-Z0-9"

# Text put where a value is missing.
MISSING_TEXT = "MISSING"
NO_COMMENT = "데이터 없음"

# Reviews: a title holding the text belongs to the brand.
REVIEW_BRANDS = [("S24", "samsung"), ("아이폰", "apple")]
BRAND_IDS = {"samsung": 1, "apple": 2}

# Hobbies offered when fewer are stored.
DEFAULT_HOBBIES = ["음악 감상", "여행", "운동", "게임", "독서", "사진 촬영", "영상시청", "요리", "등산"]

DEFAULT_TOP_HOBBIES = ["음악 감상", "여행", "운동"]

# Allowed values of a user row.
AGE_GROUPS = ["10s", "20s", "30s", "40s", "50s", "60s"]
GENDERS = ["M", "F"]

# Column names, staged file -> raw table.
COMMENT_COLUMNS = {
    "video_id": "video_id",
    "comment": "content",
    "like_count": "like_count",
    "comment_publish_date": "commented_at",
}
REVIEW_COLUMNS = {
    "item": "item_name",
    "review_content": "content",
    "scoring": "rating",
    "purchasing_date": "purchased_at",
}
COMMENT_KEY = ["video_id", "content", "commented_at"]
REVIEW_KEY = ["item_name", "content", "purchased_at"]

# Timestamp format of collected comments.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Product description: brand, model, year, spec.
CATALOGUE_TEMPLATE = "%s의 %s은 %s년에 출시된 스마트폰으로, 주요 사양은 %s입니다."

# --- End of fixed values -----------------------------------------------------

ENTITY_RULES = [(p, SAMSUNG_NAME) for p in SAMSUNG_PATTERNS] + [(p, IPHONE_NAME) for p in IPHONE_PATTERNS]
