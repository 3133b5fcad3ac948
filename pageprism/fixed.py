"""Fixed values.

Everything in this module is data that has to be exactly these values for
results to be right: word lists, limits, patterns and label tables.
"""

from __future__ import annotations

# --- Fixed values: crawl limits -------------------------------------------------
BATCH_SIZE = 50
DOM_LIMIT = 5
MAX_PAGES = 5000
MAX_PRODUCTS = 500
RELEVANCE_CHECK = 500
RELEVANCE_THRESHOLD = 2.0
MAX_LIVE_RECORDS = 250
DEFAULT_YEAR = 2024
LIVE_YEAR = "LIVE-CRAWL"
CRAWL_PREFIX = "CC-MAIN-"

# --- Fixed values: crawl ids per year -------------------------------------------
CRAWL_WEEKS = {
    2019: "04 09 13 18 22 26 30 35 39 43 47 51",
    2020: "05 10 16 24 29 34 40 45 50",
    2021: "04 10 17 21 25 31 39 43 49",
    2022: "05 21 27 33 40 49",
    2023: "06 14 23 40 50",
    2024: "10 18 22 26 30 33 38 42 46 51",
    2025: "05",
}

# --- Fixed values: file suffixes that are never pages (case-sensitive) -----------
FILE_SUFFIXES = (
    ".pdf .doc .docx .xls .xlsx .xlsm .ppt .pptx .odt .ods .odp .rtf .txt .csv "
    ".jpg .jpeg .png .gif .bmp .tiff .webp .svg .mp3 .wav .ogg .flac .mp4 .mkv .avi .mov .wmv "
    ".stl .obj .fbx .skp .gsm .rfa .dwg .dxf .blend .step .iges .3ds .gltf .glb "
    ".zip .rar .7z .tar .gz .bz2 .xz .iso .dmg .pkg .deb .rpm .appimage "
    ".exe .msi .sh .bat .cmd .ps1 .apk .bin .run .jar .war "
    ".js .css .json .xml .yaml .yml .py .java .cpp .h .c .php .cs .swift .go .rb .pl "
    ".vcf"
).split()

# --- Fixed values: path markers of product pages (regular expressions) -----------
PRODUCT_MARKERS = [
    "/product/",
    "/products/",
    "/productDetails/",
    "/produkt/",
    "/produkte/",
    "/produkter/",
    "/produkto/",
    "/prodotto/",
    r"\.product\.",
    "/p/",
    r"/.*-p-.*\.html",
    "/pro/",
    "/pdp/",
    "/dp/",
    "/ip/",
    "/item/",
    "/item-detail/",
    "/detail/",
]

# --- Fixed values: links that lead to no page -------------------------------------
NON_PAGE_PREFIXES = ["mailto:", "tel:", "javascript:", "data:", "#"]

# --- Fixed values: texts that stand for "no value" --------------------------------
PLACEHOLDERS = ["none", "null", "undefined", ""]

# --- Fixed values: price patterns in order of trust: a text that each match contains, and the pattern ----
# The value is group 1. Each pattern runs in time linear in the page: repeats that meet only characters they can't
# hold are possessive, and a scan stops where the next one starts.
PRICE_PATTERNS = [
    ("product:price:amount", r"""product:price:amount[^:\-_?!\w]*+content[:=]*+[^:\-_?!\w]*+(\d+(?:[.,]\d+)*+)"""),
    ("regularprice", r"""regularprice[^:\-_?!\w]*+content[:=]*+[^:\-_?!\w]*+(\d+(?:[.,]\d+)*+)"""),
    ("amount", r"""price(?:0[12])*+[^:\-_?!\w]*+[=:{'"><_\s]*+amount[=:{'"><_\s]*+(\d+(?:[.,]\d+)*+)"""),
    ("amount", r"""regularprice[^:\-_?!\w]*+[=:{'"><_\s]*+amount[=:{'"><_\s]*+(\d+(?:[.,]\d+)*+)"""),
    ("price-amount amount", r"""price-amount amount[><:='"\s]*<bdi>(\d+(?:[.,]\d+)*+)"""),
    ("display:none", r""""price" style="display:none;">(\d+(?:[.,]\d+)*+)"""),
    ("current", r"""[^:\-_?!\w]price[^\-_\w]current[^\-_\w:=]*+[:=][^\-_\w]*+(\d+(?:[.,]\d+)*+)"""),
    ("price", r"""[^:\-_?!\w]price(?:0[12])*+[^\-_\w:=]*+[:=][^\-_\w]*+(\d+(?:[.,]\d+)*+)"""),
    ("regularprice", r"""[^:\-_?!\w]regularprice[^\-_\w:=]*+[:=][^\-_\w]*+(\d+(?:[.,]\d+)*+)"""),
    ("content", r"""[^:\-_?!\w]price(?:0[12])*+[^\-_\w]*+content[^\-_\w]*+(\d+(?:[.,]\d+)*+)"""),
    ("data-product-price", r"""[^:\-_?!\w]price(?:0[12])*+[^\-_\w]*+data-product-price[^\-_\w]*+(\d+(?:[.,]\d+)*+)"""),
    ("regularprice", r"""[^:\-_?!\w]regularprice[^\-_\w]*+value[^\-_\w]*+(\d+(?:[.,]\d+)*+)"""),
    ("formattedvalue", r"""formattedvalue["'\s:=]*+(?:(?!formattedvalue)[$£¥円€a-z\s])*+(\d+(?:[.,]\d+)*+)"""),
    ("price_formatted", r"""price_formatted["'\s:=]*+[$£¥円€a-z\s]*+(\d+(?:[.,]\d+)*+)"""),
    ("price", r"""price(?:(?:0[12])+["'\s:=]*+[$£¥円€a-z\s]*+|["'\s:=]*+(?:(?!price(?!0[12]))[$£¥円€a-z\s])*+)(\d+(?:[.,]\d+)*+)"""),
    ("pricetotal:", r"""[^:\-_?!\w]pricetotal:[^:\-_?!\w]initialize\((\d+(?:[.,]\d+)*+)\)"""),
    ("price", r"""[^:\-_?!\w]price(?:0[12])*[^:\-_?!\w]*+[:=]*+[^:\-_?!\w]*+(\d+(?:[.,]\d+)*+)"""),
    ("regularprice", r"""[^:\-_?!\w]regularprice[^:\-_?!\w]*+[:=]*+[^:\-_?!\w]*+(\d+(?:[.,]\d+)*+)"""),
    ("content", r"""price(?:0[12])*+[^:\-_?!\w]*+content[:=]*+[^:\-_?!\w]*+(\d+(?:[.,]\d+)*+)"""),
    ("price", r"""price(?:0[12])*[^:\-_?!\w]*+[:=]*+[^:\-_?!\w]*+(\d+(?:[.,]\d+)*+)"""),
    ("pricecol", r"""\A(?:(?![^:\-_?!\w]pricecol['"\s><]*+span)[\s\S])*+[^:\-_?!\w]pricecol['"\s><]*+span\D*+(\d+(?:[.,]\d+)*+)"""),
]

# --- Fixed values: currency patterns, in the same form ----
CURRENCY_PATTERNS = [
    ("currency", r"""[^:\-_?!\w]currency['"\s]*+[:=]['"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]price\s*+currency['"\s]*+[:=]['"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]currency\s*+code['"\s]*+[:=]['"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]currency\s*+symbol['"\s]*+[:=]['"\s]*+([\w$€£¥円]*)"""),
    ("currency_code", r"""[^:\-_?!\w]currency_code['"\s]*+[:=]['"\s]*+([\w$€£¥円]*)"""),
    ("currencyiso", r"""[^:\-_?!\w]currencyiso['"\s]*+[:=]['"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]currency\s*+type['"\s]*+[:=]['"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]product\s*+currency['"\s]*+content[:='"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]price\s*+currency['"\s]*+content[:='"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]currency\s*+code['"\s]*+content[:='"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]currency\s*+symbol['"\s]*+content[:='"\s]*+([\w$€£¥円]*)"""),
    ("currency_code", r"""[^:\-_?!\w]currency_code['"\s]*+content[:='"\s]*+([\w$€£¥円]*)"""),
    ("product:price:currency", r"""[^:\-_?!\w]product:price:currency['"\s]*+content[:='"\s]*+([\w$€£¥円]*)"""),
    ("og:price:currency", r"""[^:\-_?!\w]og:price:currency['"\s]*+content[:='"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]currency['"\s]*+content[:='"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]product\s*+currency['"\s]*+value[:='"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]price\s*+currency['"\s]*+value[:='"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]currency\s*+code['"\s]*+value[:='"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]currency\s*+symbol['"\s]*+value[:='"\s]*+([\w$€£¥円]*)"""),
    ("currency_code", r"""[^:\-_?!\w]currency_code['"\s]*+value[:='"\s]*+([\w$€£¥円]*)"""),
    ("product:price:currency", r"""[^:\-_?!\w]product:price:currency['"\s]*+value[:='"\s]*+([\w$€£¥円]*)"""),
    ("og:price:currency", r"""[^:\-_?!\w]og:price:currency['"\s]*+value[:='"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]currency['"\s]*+value[:='"\s]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]product\s*+currency['"\s]*+(?:&quot;:)*+['"\s:=]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]price\s*+currency['"\s]*+(?:&quot;:)*+['"\s:=]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]currency\s*+code['"\s]*+(?:&quot;:)*+['"\s:=]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]currency\s*+symbol['"\s]*+(?:&quot;:)*+['"\s:=]*+([\w$€£¥円]*)"""),
    ("currency", r"""[^:\-_?!\w]currency['"\s]*+(?:&quot;:)*+['"\s:=]*+([\w$€£¥円]*)"""),
    ("currency_code", r"""[^:\-_?!\w]currency_code['"\s]*+(?:&quot;:)*+['"\s:=]*+([\w$€£¥円]*)"""),
    ("price_currency", r"""[^:\-_?!\w]price_currency['"\s]*+(?:&quot;:)*+['"\s:=]*+([\w$€£¥円]*)"""),
    ("price", r"""\Wprice(?:0[12])*['"><_\s:=]*([\w$€£¥円]+)"""),
    ("regularprice", r"""\Wregularprice['"><_\s:=]*([\w$€£¥円]+)"""),
    ("regularpriceamount", r"""\Wregularpriceamount['"><_\s:=]*([\w$€£¥円]+)"""),
    ("pricetotal", r"""\Wpricetotal['"><_\s:=]*([\w$€£¥円]+)"""),
    ("formattedvalue", r"""\Wformattedvalue['"><_\s:=]*([\w$€£¥円]+)"""),
    ("pricecol", r"""[^:\-_?!\w]pricecol['"\s]*+<span>['"\s]*+([\w$€£¥円]*)"""),
    ("price", r"""\Wprice(?:0[12])*['"><_\s:=]*+\d[\d.,]*\s*+(?:<span>)*+([\w$€£¥円]+)"""),
    ("product_price", r"""\Wproduct_price['"><_\s:=]*+\d[\d.,]*\s*+(?:<span>)*+([\w$€£¥円]+)"""),
    ("_amount__currency", r"""_amount__currency[><:='"\s]*+([\w$€£¥円]+)"""),
    ("pricecurrency", r"""pricecurrency" style="display:none;">([\w$€£¥円]*)"""),
    ("currencysymbol", r"""currencysymbol[><:='"\s]*+([\w$€£¥円]*)"""),
    ("pricecol", r"""\A(?:(?![^:\-_?!\w]pricecol['"\s><]*+span)[\s\S])*+[^:\-_?!\w]pricecol['"\s><]*+span['"\s<>]*+(\D*+)\d"""),
]

# --- Fixed values: social platforms -------------------------------------------------
# (platform, must match, must not match anywhere, part of the link that is kept)
SOCIAL_PLATFORMS = [
    (
        "facebook",
        r"^(?:https?:)?//(?:[^/?#]*\.)?facebook\.com(?!/(?:sharer?(?:\.php)?|ads|legal|about|groups|policy\.php|business|settings)(?:[/?#]|$))(?:[:/?#]|$)",
        r"developers|docs",
        r".*facebook\.com/.*?(?:/|$)",
    ),
    (
        "twitter",
        r"^(?:https?:)?//(?:[^/?#]*\.)?twitter\.com(?!/(?:(?:share|intent|personalization)(?:[/?#]|$)|home/?\?))(?:[:/?#]|$)",
        None,
        r".*twitter\.com/.*?(?:/|$)",
    ),
    (
        "instagram",
        r"^(?:https?:)?//(?:[^/?#]*\.)?instagram\.com(?!/(?:share|about|explore|p|tv|vp|oauth)(?:[/?#]|$))(?:[:/?#]|$)",
        r"help",
        r".*instagram\.com/.*?(?:/|$)",
    ),
    (
        "youtube",
        r"^(?:https?:)?//(?:[^/?#]*\.)?youtube\.com/",
        None,
        r".*youtube\.com/(?:user/[^/\s]+|channel/[^/\s]+|c/[^/\s]+|[^/\s]+)(?:/|$|\s)",
    ),
    ("tiktok", r"^(?:https?:)?//(?:[^/?#]*\.)?tiktok\.com/@", None, r"(?s)^.*$"),
    ("playstore", r"^(?:https?:)?//play\.google\.com(?:[:/?#]|$)", None, r"(?s)^.*$"),
    ("appstore", r"^(?:https?:)?//itunes\.apple\.com(?:[:/?#]|$)", None, r"(?s)^.*$"),
]

# --- Fixed values: item types that describe a product, in order of preference --------
PRODUCT_TYPES = ["product", "offer", "Product", "Book", "product.item", "BuyAction"]

# --- Fixed values: field names of structured markup ----------------------------------
TITLE_KEYS = ["title", "Title", "og:title", "name"]
DESCRIPTION_KEYS = ["og:description", "description", "Description"]
BRAND_KEYS = ["brand", "Brand", "product:brand", "object"]
CATEGORY_KEYS = ["category", "Category"]
CURRENCY_KEYS = ["priceCurrency", "product:price:currency"]
PRICE_KEYS = ["price", "product:price:amount", "product:price"]

# --- Fixed values: languages that can be translated ----------------------------------
TRANSLATABLE = (
    "af ar az bg bi bn ca cs cy da de ee eo es et eu fi fj fr ga gl gv ha hi ho ht hu hy id ig is it ja ka kg kj "
    "kl ko lg ln lu lv mg mh mk ml mr mt ng nl ny om pa pl rn ru rw sg sk sm sn sq ss st sv th ti tl tn to tr ts uk "
    "ur ve vi wa xh yo zh"
).split()

# --- Fixed values: product category labels, by class id -------------------------------
CLASS_LABELS = [
    "Beauty & Care Products",
    "Decorations and Décor",
    "Household and Personal Care Appliances",
    "Household Care",
    "Fragrances",
    "Clothing",
    "Flowers and Gifting",
    "Kitchenware",
    "Headwear",
    "Backpacks, Travel and Luggage",
    "Children's and Baby Toys",
    "Animals and Pet Supplies",
    "Small and Handbags",
    "Jewellery",
    "Socks, Underwear and Nightwear",
    "Food",
    "Plants and Garden",
    "Stationery and Office Supplies",
    "Arts, Crafts and Entertainment",
    "Alcoholic Beverages",
    "Non-Alcoholic Beverages",
    "Sports, Outdoor and Camping",
    "Glasses and Lenses",
    "Health Care and Pharmaceuticals",
    "Smoking and Headshop Supplies",
    "Movies, Music, Games and Other",
    "Lamps and Lighting",
    "Other Accessories",
    "Recreation and Leisure Time Hobbies",
    "Supplements and Vitamins",
    "Kitchen Appliances",
    "Swim, Work and Outdoor Clothing",
    "Shoes and Shoe Accessories",
    "Home Textiles and Rugs",
    "Headphones, Mobile Phones and Tablets",
    "Home and Living",
    "Eyewear and Sunglasses",
    "Athletic Clothing",
    "Computers and Home Entertainment",
    "Adult",
    "Books and eBooks",
    "Collectibles",
    "Hardware and Tools",
    "Kitchen and Bath",
    "Watches",
    "Hunting and Weapons",
    "Vehicles and Parts",
    "Electronics and Parts",
    "Cameras and Optics",
    "Musical Instruments",
]

# --- Common function words per language (own list, default profile of operators.language)
STOP_WORDS = {
    "da": "og det er til på som med ikke af den",
    "de": "und der die das ist mit für von nicht ein",
    "en": "the and of is for with that this are it",
    "es": "el los las del por con para una que y",
    "fr": "le les des est pour avec dans une et sur",
    "it": "il gli della che per sono con di una non",
    "nl": "het een van en niet voor met zijn op te",
    "pl": "jest nie się na do że jak dla przez oraz",
    "pt": "os uma não para com dos são mais ao em",
    "sv": "och att det som är inte för med på av",
}

# --- Common public suffixes (own list, default of operators.domains; pass the full list as a table)
# Suffixes of one label need no entry: the last label is the suffix where no rule says otherwise.
PUBLIC_SUFFIXES = (
    "co.uk org.uk me.uk ltd.uk ac.uk gov.uk com.au net.au org.au com.br net.br org.br co.jp ne.jp or.jp ac.jp co.nz net.nz org.nz "
    "co.za org.za com.mx org.mx com.tr org.tr com.cn net.cn org.cn co.kr or.kr com.sg edu.sg com.hk com.tw org.tw com.my co.id or.id "
    "web.id co.in net.in org.in firm.in co.th in.th com.vn com.ph com.pk com.bd com.np com.lk com.sa com.eg co.il org.il co.ke com.ng "
    "com.gh com.ar com.co com.pe com.ve com.uy com.ec com.py com.bo com.gt com.ua in.ua com.pl net.pl org.pl com.pt com.es org.es "
    "com.gr com.ro co.at or.at com.ru co.hu com.cy com.mt com.kz co.rs in.rs com.hr com.mk com.al co.ma com.tn com.qa com.kw com.lb"
).split()
