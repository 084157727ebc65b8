import functools
import math
import random
import re
import string
import unicodedata
from collections import Counter

from quarry.llm import fertility, vocab
from quarry.llm.fertility import Band, Rules, assess

encoder, fallback_ids = functools.cache(vocab.encoder), functools.cache(vocab.fallback_ids)
PATTERN = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, rules):
    words = PATTERN.findall(text or "")
    lines = [x for x in (text or "").split("\n") if PATTERN.search(x)]
    seen = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_dup_lines": len(lines) - len(set(lines)),
           "n_symbols": sum(c in "#*$%&|<>" for c in text or ""), "n_repeat_words": len(covered)}
    out["base_failed"] = len(words) < rules.min_words or 100 * len(covered) > rules.max_repeat_percent * len(words)
    for v, path in rules.vocabularies.items():
        encode = encoder(path)
        ids = [i for w in words for i in encode([w if path.endswith(".model") else " " + w])[0]]
        n, counts = len(ids), Counter(ids)
        out[f"{v}_tokens"] = n
        out[f"{v}_chars_per_token"] = out["word_chars"] / n if n else 0.0
        out[f"{v}_token_entropy"] = -sum(c / n * math.log2(c / n) for c in counts.values()) if n else 0.0
        out[f"{v}_fallback_share"] = int(fallback_ids(path)[ids].sum()) / max(n, 1) if ids else 0.0
    return out


def brute_reason(text, rules):
    """The verdict from the plain figures, band by band."""
    f = brute(text, rules)
    if f["base_failed"]:
        return "base"
    words, n, script = PATTERN.findall(text), max(f["word_chars"], 1), fertility._script(text)
    punct = sum(c in string.punctuation for w in words for c in w)
    glued = sum(c in "#*$%&|<>" for w in words if any(c not in string.punctuation for c in w) for c in w)
    glued = glued if 100 * glued > rules.glued_percent * f["word_chars"] else 0
    accents = sum(c > "\x7f" for w in words for c in w) / n
    seen = Counter(words)
    again = sum(len(w) for w in words if seen[w] > 1 and len(w) >= 3)
    language = 100 * accents >= rules.accented_percent and 100 * again >= rules.recurring_percent * n
    votes = {}
    for v in rules.vocabularies:
        key = next(k for k in (f"{v}:{script}", script, "*") if k in rules.bands)
        b = rules.bands[key]
        if b is None:
            continue
        low = max(b.min_chars_per_token - b.accent_slope * accents - b.punctuation_slope * (punct - glued) / n,
                  min(b.min_chars_per_token, b.floor_chars_per_token))
        ratio = f[f"{v}_chars_per_token"]
        votes[v] = {
            "chars_per_token": ratio * (1 - glued / n) < low and not language or ratio > b.max_chars_per_token,
            "fallback_share": f[f"{v}_fallback_share"] > b.max_fallback + b.fallback_slope * accents,
            "token_entropy": f[f"{v}_tokens"] >= rules.entropy_tokens
            and f[f"{v}_token_entropy"] < b.min_entropy - b.entropy_slope * accents}
    for what in ("chars_per_token", "fallback_share", "token_entropy"):
        if votes and all(x[what] for x in votes.values()):
            return f"{next(iter(votes))}_{what}"
    return None


def test_against_brute_force(frame):
    base = "The quick brown fox jumps over the lazy dog. " * 2
    texts = [None, "", base, " ".join(f"word{i} and thing{i}" for i in range(60)), "a b c a b c x\n\nq\nq\n q\nq",
             "# | < $ é 漢字" * 30, " ".join(f"漢{i}字 слово{i}" for i in range(80)), "\n \n\t\n", "line one\r\nline one\r\nx"]
    rules = Rules()
    got = {r.doc_id: r.asDict() for r in assess(frame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        for column, value in brute(text, rules).items():
            assert got[i][column] == value if isinstance(value, int) else abs(got[i][column] - value) < 1e-9, (i, column)
        assert got[i]["kept"] == (got[i]["reason"] is None) and got[i]["reason"] == brute_reason(text, rules)


def test_bands_reject_by_script(frame):
    rng = random.Random(1)
    prose = " ".join(rng.choice("every house number stands along the quiet street near water with some old trees".split()) for _ in range(70))
    noise = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)) for _ in range(100))
    assert len(set(noise.split())) == 100  # else the base rule would be first
    rules = Rules(bands={"latin": Band(2.5, 8.0, 0.1, 3.0), "*": Band(0.0, 99.0, 1.0, 0.0)})
    got = {r.doc_id: r for r in assess(frame([(0, prose), (1, noise)], "doc_id long, text string"), rules=rules).collect()}
    assert got[0].kept and not got[1].kept and got[1].reason == "multi_chars_per_token" and got[1].script == "latin"
    assert fertility._script("привет world мир") == "cyrillic" and fertility._script("漢字かなabc漢漢") == "han"
    assert fertility._script("123 !") == "common" and fertility._script("état") == "latin"


def test_hard_rows(hard, none):
    got = assess(hard)
    assert dict(got.dtypes)["n_words"] == "bigint" and dict(got.dtypes)["kept"] == "boolean" and "_class" in got.columns
    rows = got.collect()
    assert len(rows) == hard.count() and not any(r.kept for r in rows if r.n_words == 0)
    assert [r.n_words for r in rows if r.doc_id == 5] == [30000] and [r.base_failed for r in rows if r.doc_id == 5] == [True]
    assert assess(none).columns == got.columns and assess(none).count() == 0
    assert assess(hard, only_kept=True).schema == hard.schema


#: Article 1 of the human rights declaration, and lines of source code.
CLEAN = {
    "vi": "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi. Mọi con người đều được tạo hoá "
          "ban cho lý trí và lương tâm và cần phải đối xử với nhau trong tình anh em.",
    "yo": "Gbogbo ènìyàn ni a bí ní òmìnira; iyì àti ẹ̀tọ́ kọ̀ọ̀kan sì dọ́gba. Wọ́n ní ẹ̀bùn làákàyè àti ti ẹ̀rí-ọkàn, ó sì yẹ kí "
          "wọn ó máa hùwà sí ara wọn gẹ́gẹ́ bí ọmọ ìyá.",
    "az": "Bütün insanlar ləyaqət və hüquqlarına görə azad və bərabər doğulurlar. Onların şüurları və vicdanları var və "
          "bir-birlərinə münasibətdə qardaşlıq ruhunda davranmalıdırlar.",
    "nv": "Bila'ashda'ii t'áá ałtsoh yiníkʼehgo bidizhchį́įh dóó aheełt'eego ílį́į́go bee baahóchįʼ. Eíí háníʼ dóó "
          "hánítshákees hwiihdaasyaʼ eíí binahjįʼ ahidiníłnáhgo álíleekʼehgo kʼé bee ahił niidlį́.",
    "code": "for (int i = 0; i < n; i++) { if (a[i] != b[i]) { x += f(a[i], b[i]) * 2; } else { y -= g(c[i]); } } "
            "return x >= y ? x : -y;",
}


def test_clean_languages_stay_and_random_characters_go(frame):
    rng = random.Random(5)
    lower = "abcdefghijklmnopqrstuvwxyz"
    viet = "".join(sorted({c for c in CLEAN["vi"].lower() if c > "\x7f"}))
    pools = [lower, lower.upper(), lower + lower.upper() + "0123456789", "".join(map(chr, range(33, 127))), lower + viet, viet,
             lower * 3 + viet, "".join(map(chr, range(0xC0, 0x180))), lower + "".join(map(chr, range(0xC0, 0x250)))]
    clean = [*CLEAN.values(), *(unicodedata.normalize("NFD", CLEAN[k]) for k in ("vi", "yo", "az"))]
    noise = [" ".join("".join(rng.choice(p) for _ in range(rng.randint(low, 10))) for _ in range(n))
             for p in pools for low, n in ((6, 80), (1, 400))]
    noise += ["".join(c if c == " " else rng.choice(CLEAN[k].replace(" ", "")) for c in CLEAN[k] * 3) for k in ("vi", "yo")]
    rows = frame(list(enumerate(clean + noise)), "doc_id long, text string")
    got = {r.doc_id: r for r in assess(rows, rules=Rules(min_words=10, max_repeat_percent=100)).collect()}
    assert {r.script for r in got.values()} == {"latin"}
    assert [got[i].reason for i in range(len(clean))] == [None] * len(clean)
    assert [i for i in range(len(clean), len(got)) if got[i].kept] == []
    assert {i: r.reason for i, r in got.items()} == {
        i: brute_reason(t, Rules(min_words=10, max_repeat_percent=100)) for i, t in enumerate(clean + noise)}


def test_words_used_again_save_letters_no_vocabulary_knows(frame):
    rng = random.Random(6)
    letters = [chr(c) for c in range(0x1E00, 0x1E80)]
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 6))) for _ in range(2000)]
    texts = [" ".join(words[:200]), " ".join(rng.choice(words[:60]) for _ in range(200))]
    rules = Rules(bands={"*": Band(2.0, 8.0, 1.0, 0.0)})
    got = {r.doc_id: r.reason for r in assess(frame(list(enumerate(texts)), "doc_id long, text string"), rules=rules).collect()}
    assert got == {0: "multi_chars_per_token", 1: None}


#: Article 1 of the human rights declaration again, and the opening of the Doctrine of the Mean.
PROSE = {
    "cyrillic": [
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны "
        "поступать в отношении друг друга в духе братства.",
        "Барлық адамдар тумысынан азат және қадір-қасиеті мен кұқықтары тең болып дүниеге келеді. Адамдарға ақыл-парасат, "
        "ар-ождан берілген, сондықтан олар бір-бірімен туыстық, бауырмалдық қарым-қатынас жасаулары тиіс.",
        "Хүн бүр төрж мэндлэхэд эрх чөлөөтэй, адилхан нэр төртэй, ижил эрхтэй байдаг. Оюун ухаан, нандин чанар заяасан хүн "
        "гэгч өөр хоорондоо ахан дүүгийн үзэл санаагаар харьцах учиртай."],
    "greek": ["Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με "
              "λογική και συνείδηση, και οφείλουν να συμπεριφέρονται μεταξύ τους με πνεύμα αδελφοσύνης."],
    "hebrew": ["כל בני האדם נולדו בני חורין ושווים בערכם ובזכויותיהם. כולם חוננו בתבונה ובמצפון, לפיכך חובה עליהם לנהוג איש "
               "ברעהו ברוח של אחווה."],
    "arabic": ["يولد جميع الناس أحرارا متساوين في الكرامة والحقوق. وقد وهبوا عقلا وضميرا وعليهم أن يعامل بعضهم بعضا بروح الإخاء.",
               "تمام افراد بشر آزاد به دنیا می‌آیند و از لحاظ حیثیت و حقوق با هم برابرند. همه دارای عقل و وجدان هستند و باید "
               "نسبت به یکدیگر با روح برادری رفتار کنند."],
    "devanagari": ["सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है। उन्हें बुद्धि और अन्तरात्मा की "
                   "देन प्राप्त है और परस्पर उन्हें भाईचारे के भाव से बर्ताव करना चाहिए।"],
    "bengali": ["সমস্ত মানুষ স্বাধীনভাবে সমান মর্যাদা এবং অধিকার নিয়ে জন্মগ্রহণ করে। তাঁদের বিবেক এবং বুদ্ধি আছে; সুতরাং সকলেরই একে "
                "অপরের প্রতি ভ্রাতৃত্বসুলভ মনোভাব নিয়ে আচরণ করা উচিৎ।"],
    "thai": ["มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกันในเกียรติศักดิ์และสิทธิ ต่างมีเหตุผลและมโนธรรม และควรปฏิบัติต่อกันด้วยเจตนารมณ์แห่งภราดรภาพ"],
    "han": ["人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
            "天命之謂性，率性之謂道，修道之謂教。道也者，不可須臾離也，可離非道也。是故君子戒慎乎其所不睹，恐懼乎其所不聞。"],
    "kana": ["すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられており、互いに同胞の精神をもって行動しなければならない。"],
    "hangul": ["모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로 형제애의 정신으로 행동하여야 한다."],
}
LETTERS = {"cyrillic": (0x430, 0x450), "greek": (0x3B1, 0x3CA), "hebrew": (0x5D0, 0x5EB), "arabic": (0x627, 0x64B),
           "devanagari": (0x905, 0x93A), "bengali": (0x985, 0x9B3), "thai": (0xE01, 0xE2F), "han": (0x4E00, 0x9FA6),
           "kana": (0x3041, 0x3097), "hangul": (0xAC00, 0xD7A4)}


def test_prose_of_every_script_stays_and_its_letters_at_random_go(frame):
    rng = random.Random(8)
    prose = [(s, t) for s, texts in PROSE.items() for t in texts]
    noise = [(s, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(low, 10))) for _ in range(200)))
             for s, (a, b) in LETTERS.items() for letters in [[chr(c) for c in range(a, b) if chr(c).isalpha()]] for low in (1, 4)]
    rules = Rules(min_words=1, max_repeat_percent=100)
    rows = frame([(i, t) for i, (_, t) in enumerate(prose + noise)], "doc_id long, text string")
    got = {r.doc_id: r for r in assess(rows, rules=rules).collect()}
    assert [got[i].script for i in range(len(got))] == [s for s, _ in prose + noise]
    assert [got[i].reason for i in range(len(prose))] == [None] * len(prose)
    assert [(got[i].script, i) for i in range(len(prose), len(got)) if got[i].kept] == []
    assert {i: r.reason for i, r in got.items()} == {i: brute_reason(t, rules) for i, (_, t) in enumerate(prose + noise)}


def test_symbols_strewn_through_words_go_code_and_tables_stay(frame):
    rng = random.Random(9)
    parts = "th he an er ion ent ing ed at on re in is it ou ea ti".split()
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 5))) for _ in range(500)]
    strewn = [" ".join(w + 3 * rng.choice("#*$%&") for w in words[:n]) for n in (80, 500)]
    generic = ("std::map<std::string, std::vector<int>> &seen = table[*at]; for (auto &entry : seen) { total += weight * entry.second[0]; "
               "if (entry.first < limit && total > least) return &entry; } while (*from && from < end) *to++ = *from++;")
    table = " ".join(f"| {a} {b} | {c} {d} |" for a, b, c, d in zip(*[iter(words)] * 4, strict=True))
    page = " ".join(f'<p class="lead">{a} {b} {c}</p> <a href="/{b}">{c} of {a}</a>' for a, b, c in zip(*[iter(words)] * 3, strict=False))
    texts = [*strewn, " ".join(words), generic, table, page]
    rules = Rules(min_words=10, max_repeat_percent=100)
    got = {r.doc_id: r.reason for r in assess(frame(list(enumerate(texts)), "doc_id long, text string"), rules=rules).collect()}
    assert got == {0: "multi_chars_per_token", 1: "multi_chars_per_token", 2: None, 3: None, 4: None, 5: None}
    assert got == {i: brute_reason(t, rules) for i, t in enumerate(texts)}


def test_a_vocabulary_without_a_band_does_not_judge(frame):
    rows = frame([(0, " ".join(f"word{i}" for i in range(60)))], "doc_id long, text string")
    never, low = Band(99.0, 100.0, 1.0, 0.0), Band(0.0, 99.0, 1.0, 0.0)
    for bands, reason in (({"*": None}, None), ({"*": never}, "multi_chars_per_token"), ({"*": None, "piece:latin": never},
                          "piece_chars_per_token"), ({"*": low, "piece:latin": never}, None)):
        assert [r.reason for r in assess(rows, rules=Rules(bands=bands)).collect()] == [reason]
