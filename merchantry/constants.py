"""Fixed values that results depend on: word lists, lookup tables, thresholds, weights."""

# Keyword -> product category. The first rule that matches anywhere in the
# description wins, so the order is part of the value.
CATEGORY_RULES = [
    ("Fashion & Clothing", "DRESS|SCARF|SHIRT|COAT|JACKET|GLOVE|SOCK|HAT|CAPE|APRON|SKIRT|VEST|SWEATER|BLOUSE"),
    ("Bags & Accessories", "BAG|PURSE|HANDBAG|WALLET|BACKPACK|TOTE|SHOPPER|POUCH"),
    (
        "Kitchen & Dining",
        "MUG|CUP|PLATE|BOWL|BOTTLE|GLASS|TRAY|TEAPOT|COFFEE|TEA SET|COASTER|NAPKIN|SPOON|FORK|JUG",
    ),
    (
        "Home & Decor",
        "CANDLE|CUSHION|FRAME|LAMP|CLOCK|MIRROR|VASE|RUG|CURTAIN|DOORMAT|HOOK|HOLDER|DRAWER|SHELF|STORAGE",
    ),
    (
        "Gifts & Seasonal",
        "CHRISTMAS|XMAS|EASTER|BIRTHDAY|PARTY|GIFT|WEDDING|VALENTINE|HALLOWEEN|RIBBON|WRAP|BOW",
    ),
    ("Stationery & Cards", "PEN|PENCIL|NOTEBOOK|JOURNAL|CARD|STICKER|STAMP|PAPER|LETTER|POSTCARD|TAG|LABEL"),
    ("Toys & Crafts", "TOY|GAME|DOLL|PUZZLE|CRAFT|PAINT|BEAD|SEWING"),
]
DEFAULT_CATEGORY = "General"

# Country -> sales region.
REGION_COUNTRIES = {
    "Europe": [
        "United Kingdom", "France", "Germany", "Spain", "Italy", "Netherlands", "Belgium", "Switzerland",
        "Portugal", "Norway", "Sweden", "Denmark", "Finland", "Austria", "Ireland", "Poland", "Czech Republic",
        "Greece", "Iceland", "Malta", "Cyprus", "Lithuania", "Channel Islands", "EIRE", "European Community",
    ],
    "North America": ["USA", "Canada"],
    "South America": ["Brazil"],
    "Oceania": ["Australia"],
    "Asia": ["Japan", "Singapore", "Hong Kong"],
    "Middle East": ["Israel", "Lebanon", "United Arab Emirates", "Bahrain", "Saudi Arabia"],
    "Africa": ["South Africa", "Nigeria", "RSA"],
}
DEFAULT_REGION = "Other"

# Review class -> image class.
IMAGE_CLASSES = {
    "Gaun": ["Dresses"],
    "Kaos": ["Knits", "Fine gauge"],
    "Kemeja": ["Blouses"],
    "Sweter": ["Sweaters"],
    "Celana_Panjang": ["Pants"],
    "Jeans": ["Jeans"],
    "Rok": ["Skirts"],
    "Jaket": ["Jackets"],
    "Mantel": ["Outerwear"],
    "Celana_Pendek": ["Shorts"],
}
DEFAULT_IMAGE_CLASS = "Lainnya"

# Price bands (upper bound inclusive) and their display order.
PRICE_EDGES = (2.0, 5.0, 15.0)
PRICE_BANDS = ("Low", "Medium", "High", "Premium")

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Right-closed bins of the purchase-frequency and age reports.
FREQUENCY_EDGES = (0, 1, 3, 5, 10, 50, 1000)
FREQUENCY_LABELS = ("1 order", "2-3", "4-5", "6-10", "11-50", "50+")
AGE_EDGES = (17, 25, 35, 45, 55, 100)
AGE_LABELS = ("18-25", "26-35", "36-45", "46-55", "56+")

# Published constants of the lexicon scorer (Hutto & Gilbert 2014).
NEGATION_FACTOR = -0.74
COMPOUND_ALPHA = 15.0

# Blend of the hybrid recommender.
COLLABORATIVE_WEIGHT = 0.6
CONTENT_WEIGHT = 0.4

# Soft-voting weights per model.
VOTING_WEIGHTS = {
    "Gradient Boosting": 2.0,
    "XGBoost": 2.0,
    "MLP Neural Network": 1.5,
    "Random Forest": 1.0,
    "SVM": 1.0,
    "Logistic Regression": 0.5,
}

# Columns that must not reach the churn models.
CHURN_EXCLUDED = (
    "CustomerID", "JoinDate", "FirstOrderDate", "LastOrderDate", "ChurnLabel", "Country", "Recency",
    "TotalOrders", "AvgOrderValue", "AvgQuantityPerOrder", "TotalItems", "RFM_Segment",
)
