"""Fixed values that results depend on."""

# Abbreviations and their expansions, applied in this order.
ABBREVIATIONS = {
    "Std.": "Stunden", "Min.": "Minuten", "Sek.": "Sekunden", "Jr.": "Jahr", "Tg.": "Tage", "m ü. M.": "Meter über Meer", "u.a.": "unter anderem",
    "sog.": "sogenannte", "bzw.": "beziehungsweise", "ca.": "circa", "z.B.": "zum Beispiel", "d.h.": "das heisst", "D.h": "das heisst",
    "etc.": "et cetera", "z.T.": "zum Teil", "i.d.R.": "in der Regel", "u.v.m.": "und vieles mehr", "Nr.": "Nummer", "b.a.w.": "bis auf weiteres",
    "n.Chr.": "nach Christus", "v.Chr.": "vor Christus", "ggf.": "gegebenenfalls", "evtl.": "eventuell", "u.U.": "unter Umständen",
    "v.a.": "vor allem", "vgl.": "vergleiche", "inkl.": "inklusive", "zzgl.": "zuzüglich", "u.s.w.": "und so weiter", "bzgl.": "bezüglich",
    "s.a.": "siehe auch", "bspw.": "beispielsweise", "Hbf.": "Hauptbahnhof", "Dr.": "Doktor", "Dipl.": "Diplom", "Univ.": "Universität",
    "km/h": "Kilometer pro Stunde", "ms/s": "Meter pro Sekunde", "Gebr.": "Gebrüder", "äSEND$": " ", "Mio.": "Millionen", "Mia.": "Milliarden",
    "ähm": "", "äh": "", "hm": "", "hm...": "", "Öhh...": "", "Öhh": "",
}

# Literal replacements of typographic characters, applied in this order.
REPLACEMENTS = {
    "\u00a0": " ", "\u202f": " ", "\u200b": "", "\u200c": "", "\u200d": "", "\u2060": "",
    "‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "«": '"', "»": '"', "„": '"', "‟": '"',
    "-": "-", "–": "-", "—": "-", "−": "-", "--": "-", "…": "...", "ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ß": "ss", "•": "-", "·": "-",
    "<i>": "", "</i>": "", "<b>": "", "</b>": "", "\u00ad": "", "- -": "-", "/, ": "",
}

# Spaces that the typographic replacements fold into one.
ODD_SPACES = "\u00a0\u202f\u200b\u200c\u200d\u2060"

# Characters that stand for an apostrophe.
APOSTROPHES = "’‘ˊˋʹ＇`"

# Spacing around punctuation, applied in this order.
PUNCTUATION_SPACING = {".,": ".", "  ": " ", " ?": "?", " !": "!", " . ": ". ", ". <": ".<", "! <": "!<", "? <": "?<", ", <": ",<"}

# Currency signs and codes, replaced anywhere, in this order.
CURRENCIES = {
    "$": "Dollar", "€": "Euro", "£": "Pfund", "¥": "Yen", "₹": "Rupie", "₽": "Rubel", "₩": "Won", "₫": "Dong", "₣": "Franken", "₦": "Naira",
    "₴": "Hrywnja", "₲": "Guarani", "₵": "Cedi", "฿": "Baht", "₺": "Türkische Lira", "₼": "Manat", "₪": "Schekel", "₭": "Kip", "₨": "Rupie",
    "₱": "Peso", "₳": "Austral", "₡": "Colon", "₢": "Cruzeiro", "₥": "Mill", "₧": "Peseta", "₮": "Tugrik", "₯": "Drachme", "₰": "Pfennig",
    "₷": "Speciedaler", "%": "Prozent", "Fr.": "Franken", "CHF": "Franken", "USD": "Dollar", "EUR": "Euro", "GBP": "Pfund", "JPY": "Yen",
    "CNY": "Yuan", "INR": "Rupie", "RUB": "Rubel", "KRW": "Won", "VND": "Dong", "NGN": "Naira", "UAH": "Hrywnja", "GHS": "Cedi", "THB": "Baht",
    "TRY": "Türkische Lira", "AZN": "Manat", "ILS": "Schekel", "LAK": "Kip", "PKR": "Rupie", "PHP": "Peso", "ARS": "Peso", "CRC": "Colon",
    "BRL": "Real", "CLP": "Peso", "MXN": "Peso", "SGD": "Dollar", "HKD": "Dollar",
}

# Words that make French or English likely.
FRENCH_WORDS = "que qui dans avec pour chez entre sans leur leurs un une des du la le les il elle ils elles ça est sera sont".split()
FRENCH_ELISIONS = "l d c j t m n s q qu".split()
ENGLISH_WORDS = "the and that with this from for you your are was were have has not but they their what when where would could should".split()
ENGLISH_ELISIONS = "i you we they it he she".split()

# Languages written without spaces between words.
UNSPACED_LANGUAGES = ("zh", "ja", "th", "lo", "my")

# Limits in milliseconds, tokens, characters and seconds.
SEGMENT_MS, SAMPLE_RATE, RESOLUTION_MS = 30_000, 16_000, 20
MAX_PROMPT_TOKENS, MAX_RECORD_TOKENS, REPEAT_THRESHOLD = 223, 219, 3
CAPTION_CHARS, CAPTION_SECONDS, CAPTION_GAP = 42, 7, 0.02
MAX_COMPRESSION, FEW_WORDS = 2.4, 8
