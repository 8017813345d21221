"""Vocabulary of the catalog rules. Results depend on these words and their order."""

# Category rules, first match wins.
CATEGORY_RULES = (
    ("hoodies", ("hoodie", "hooded", "هودي", "هودى", "بفته بكاب")),
    ("sweatshirts", ("sweatshirt", "sweater", "pullover", "jumper", "cardigan", "سويت شيرت", "سويت", "بلوفر", "كارديجان")),
    ("t-shirts", ("t-shirt", "tshirt", "t shirt", "tee", "polo", "tank top", "tank", "crop top", "camisole", "top", "long sleeve", "longsleeve", "short sleeve", "sleeveless", "crew neck", "v-neck", "v neck", "round neck", "تيشيرت", "تي شيرت", "تيشرت", "بولو", "توب", "تانك")),
    ("shirts", ("shirt", "blouse", "قميص", "قمصان", "بلوزة")),
    ("jackets", ("jacket", "coat", "blazer", "windbreaker", "parka", "puffer", "gilet", "جاكيت", "جاكت", "بالطو", "بليزر", "معطف")),
    ("vests", ("vest", "waistcoat", "صدرية", "جيليه")),
    ("jumpsuits", ("jumpsuit", "romper", "playsuit", "overalls", "dungaree", "جمبسوت", "بذلة")),
    ("tracksuits", ("tracksuit", "co-ord", "بدلة رياضية")),
    ("jeans", ("jean", "denim", "جينز", "دنيم")),
    ("shorts", ("short", "شورت", "شورتات")),
    ("pants", ("pant", "trouser", "legging", "jogger", "chino", "cargo", "sweatpant", "straight leg", "straight-leg", "wide leg", "wide-leg", "بنطلون", "بنطال", "بنطلونات", "ليجن", "جوجر", "شينو", "كارجو")),
    ("skirts", ("skirt", "جيبة", "تنورة", "جيبه")),
    ("dresses", ("dress", "gown", "kaftan", "abaya", "galabeya", "jalabiya", "thobe", "wrap", "cover-up", "coverup", "bodycon", "maxi", "midi", "mini", "فستان", "فساتين", "كافتان", "عباية", "جلابية")),
    ("swimwear", ("swimwear", "swimsuit", "bikini", "swim trunk", "one piece", "one-piece", "jammer", "rashguard", "rash guard", "wetsuit", "burkini", "swimming", "swim hijab", "swim cap", "swim bonnet", "مايوه", "بيكيني", "بوركيني")),
    ("hijab", ("hijab", "khimar", "headscarf", "حجاب", "خمار")),
    ("shoes", ("shoe", "sneaker", "trainer", "footwear", "sandal", "boot", "slipper", "حذاء", "احذية", "أحذية", "كوتشي", "سنيكرز", "صندل", "بوت", "جزمة", "شبشب")),
    ("activewear", ("activewear", "sportswear", "gym", "training", "workout", "sport bra", "tights", "hip cover", "رياضي", "رياضى", "جيم", "تدريب")),
    ("underwear", ("underwear", "boxer", "brief", "lingerie", "bra", "panty", "panties", "intimate", "bodysuit", "body suit", "ملابس داخلية", "بوكسر", "حمالة")),
    ("socks", ("sock", "شراب", "جوارب", "شرابات")),
    ("accessories", ("accessory", "accessories", "scarf", "hat", "cap", "belt", "bag", "wallet", "sunglass", "sunglasses", "watch", "glove", "beanie", "necktie", "tie", "اكسسوار", "إكسسوار", "وشاح", "ايشارب", "طرحة", "قبعة", "حزام", "شنطة", "حقيبة", "نظارة", "ساعة")),
)
# Words of those rules that free descriptions use in other senses.
DESCRIPTION_AMBIGUOUS = ("top", "short", "overall", "denim", "t-shirt", "tshirt", "t shirt", "tee", "activewear", "sportswear", "training", "workout", "gym", "swimming")
# Substrings of goods that are no fashion.
NON_FASHION = ("phone", "laptop", "tablet", "charger", "headphone", "earbud", "camera", "television", "tv ", "refrigerator", "microwave", "blender", "vacuum", "furniture", "sofa", "mattress", "grocery", "snack", "beverage", "supplement", "tyre", "tire", "engine", "motor oil", "toy", "video game", "console")
# Gender terms.
KIDS = ("kid", "child", "boy", "girl", "infant", "toddler", "junior", "اطفال", "أطفال", "اولادي", "ولادي", "بناتي", "بيبي", "طفل")
UNISEX = ("unisex", "للجنسين", "الجنسين")
MEN_WORDS, MEN_PARTS = ("men", "man", "male", "mens", "men's"), ("رجالي", "رجالى", "رجال", "رجاليه")
WOMEN_WORDS, WOMEN_PARTS = ("women", "woman", "female", "womens", "women's", "ladies", "lady"), ("نسائي", "نسائى", "حريمي", "حريمى", "سيدات", "ليديز")
# Colours and their synonyms, in order of preference on ties.
COLORS = (
    ("Black", ("black", "اسود", "أسود")), ("White", ("white", "ابيض", "أبيض", "أوف وايت", "off white")), ("Red", ("red", "احمر", "أحمر")),
    ("Navy", ("navy", "كحلي", "نيفي")), ("Blue", ("blue", "ازرق", "أزرق", "لبني", "سماوي")), ("Green", ("green", "اخضر", "أخضر")),
    ("Olive", ("olive", "زيتي", "زيتوني")), ("Khaki", ("khaki", "كاكي")), ("Yellow", ("yellow", "اصفر", "أصفر")),
    ("Gray", ("gray", "grey", "رمادي", "جراي", "رصاصي")), ("Brown", ("brown", "بني")), ("Beige", ("beige", "بيج")),
    ("Pink", ("pink", "وردي", "بمبي", "روز", "زهري")), ("Purple", ("purple", "بنفسجي", "موف")), ("Orange", ("orange", "برتقالي")),
    ("Gold", ("gold", "ذهبي", "دهبي")), ("Silver", ("silver", "فضي")), ("Maroon", ("maroon", "عنابي", "خمري")),
)
# Currency symbols and codes.
CURRENCIES = {"egp": "EGP", "le": "EGP", "l.e": "EGP", "ج.م": "EGP", "جنيه": "EGP", "usd": "USD", "$": "USD", "eur": "EUR", "€": "EUR", "gbp": "GBP", "£": "GBP", "sar": "SAR", "aed": "AED"}
# Materials and their synonyms.
MATERIALS = (
    ("cotton", ("cotton", "قطن")), ("polyester", ("polyester", "بوليستر")), ("wool", ("wool", "صوف")), ("silk", ("silk", "حرير")),
    ("linen", ("linen", "كتان")), ("denim", ("denim", "دنيم", "جينز")), ("leather", ("leather", "جلد")), ("nylon", ("nylon", "نايلون")),
    ("viscose", ("viscose", "فيسكوز")), ("spandex", ("spandex", "elastane", "lycra", "ليكرا", "ايلاستان")), ("cashmere", ("cashmere", "كشمير")),
    ("modal", ("modal", "مودال")), ("acrylic", ("acrylic", "اكريليك")), ("fleece", ("fleece", "فليس")), ("satin", ("satin", "ساتان")), ("chiffon", ("chiffon", "شيفون")),
)
# What is in scope.
CLOTHING = (
    "t-shirt", "tshirt", "t shirt", "tee", "polo", "shirt", "blouse", "top", "camisole", "tank",
    "hoodie", "hooded", "sweatshirt", "sweater", "pullover", "jumper", "cardigan", "jacket", "coat", "blazer", "windbreaker", "parka", "puffer", "vest", "waistcoat", "gilet",
    "jeans", "denim", "pant", "trouser", "chino", "jogger", "sweatpant", "legging", "shorts", "short",
    "dress", "gown", "skirt", "jumpsuit", "romper", "playsuit", "overall", "dungaree", "tracksuit", "co-ord",
    "abaya", "kaftan", "caftan", "galabeya", "jalabiya", "jalabiyya", "thobe", "kandura", "hijab", "khimar",
    "underwear", "boxer", "brief", "lingerie", "bra", "sport bra", "panty", "thong", "bodice", "bodysuit",
    "swimwear", "swimsuit", "bikini", "swim trunk", "one piece", "one-piece", "jammer", "rashguard", "rash guard", "wetsuit", "activewear", "sportswear",
    "pajama", "pyjama", "sleepwear", "nightgown", "nightwear", "robe", "sock", "stocking", "tights",
    "long sleeve", "short sleeve", "sleeveless", "half sleeve", "crew neck", "v-neck", "v neck", "round neck", "turtleneck", "halter", "strapless", "bodycon", "maxi", "midi", "wrap", "maternity",
    "قميص", "قمصان", "تي شيرت", "تيشيرت", "تيشرت", "بلوزة", "توب", "تانك", "كروب توب", "هودي", "هودى", "بفته بكاب", "سويت شيرت", "سويت", "بلوفر", "كارديجان",
    "جاكيت", "جاكت", "معطف", "بالطو", "بليزر", "بنطلون", "بنطال", "بنطلونات", "جينز", "دنيم", "شورت", "شورتات", "ليجن", "فستان", "فساتين", "تنورة", "جيبة", "جيبه",
    "جلابية", "جلاليب", "عباية", "كافتان", "ملابس داخلية", "بوكسر", "حمالة", "مايوه", "بيكيني", "ملابس رياضية", "بدلة رياضية", "بيجامة", "بيجاما", "شراب", "جوارب", "شرابات", "ملابس",
)
FOOTWEAR = (
    "shoe", "sneaker", "trainer", "footwear", "sandal", "boot", "slipper", "loafer", "heel", "stiletto", "flats", "ballet flat", "mule", "clog", "espadrille", "moccasin",
    "athletic shoe", "running shoe", "court shoe", "حذاء", "احذية", "أحذية", "كوتشي", "سنيكرز", "صندل", "صنادل", "بوت", "جزمة", "شبشب", "خف", "كعب", "بلغة",
)
# What is out of scope, by reason; first match wins.
OUT_OF_SCOPE = (
    ("electronics", ("headphone", "earphone", "earbud", "earpiece", "headset", "smartwatch", "smart watch", "fitness tracker", "activity tracker", "speaker", "bluetooth speaker", "charger", "power bank", "cable", "phone", "smartphone", "tablet", "laptop", "camera", "gadget", "سماعة", "سماعات", "ساعة ذكية", "شاحن", "هاتف")),
    ("sports_equipment", ("dumbbell", "barbell", "kettlebell", "weight plate", "weight rack", "resistance band", "treadmill", "elliptical", "exercise bike", "rowing machine", "pull-up bar", "yoga mat", "exercise mat", "jump rope", "skipping rope", "slam ball", "medicine ball", "football", "basketball", "volleyball", "tennis ball", "racket", "racquet", "badminton", "cricket bat", "tent", "sleeping bag", "kayak", "canoe", "paddle", "compass", "binocular", "fishing rod", "tackle", "bicycle", "bike", "skateboard", "scooter", "helmet", "shin guard", "knee pad", "elbow pad", "climbing harness", "carabiner", "hiking pole", "camping", "cooler", "lantern", "hydration pack", "دمبل", "اثقال", "حبل مقاومة", "حصيرة يوغا", "دراجة", "خيمة", "مضرب", "كرة قدم", "معدات رياضية", "معدة رياضية")),
    ("home_goods", ("water bottle", "bottle", "tumbler", "flask", "thermos", "mug", "cup", "towel", "bath towel", "furniture", "chair", "sofa", "mattress", "pillow", "blanket", "cushion", "lamp", "vase", "rug", "curtain", "cookware", "kitchenware", "utensil", "زجاجة مياه", "زجاجة", "منشفة", "اثاث", "طقم أكواب")),
    ("accessory", ("wallet", "purse", "coin purse", "bag", "handbag", "tote", "clutch", "crossbody", "backpack", "rucksack", "satchel", "duffel", "luggage", "suitcase", "trolley bag", "belt", "watch", "jewelry", "jewellery", "necklace", "bracelet", "earring", "pendant", "brooch", "anklet", "ring", "sunglasses", "sunglass", "eyewear", "eyeglasses", "spectacle", "scarf", "shawl", "hat", "cap", "beanie", "beret", "bucket hat", "glove", "mitten", "hair clip", "hairband", "headband", "hair tie", "scrunchie", "keychain", "lanyard", "محفظة", "محافظ", "حقيبة", "حقائب", "شنطة", "شنط", "حزام", "احزمة", "ساعة", "مجوهرات", "مجوهر", "عقد", "سوار", "حلق", "قلادة", "خاتم", "نظارة", "نظارات", "نظارة شمسية", "وشاح", "ايشارب", "طرحة", "قبعة", "قبعات", "قفاز", "قفازات", "هيرباند", "كليب شعر")),
)
# Scope words that descriptions use in other senses.
DESCRIPTION_CLOTHING_AMBIGUOUS = ("top", "short", "overall", "denim", "tank", "cap")
DESCRIPTION_FOOTWEAR_AMBIGUOUS = ("heel",)
# Option names of storefront payloads.
SIZE_OPTIONS, COLOR_OPTIONS = ("size", "المقاس", "مقاس"), ("color", "colour", "اللون", "لون")
