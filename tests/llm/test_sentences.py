import pytest

from obsforge.llm.sentences import sentence_units, sentences, words

# Each list is one text, its sentences in order; they are joined by a blank (or as given by the text itself).
SPACED = {
    "en": ["The device starts again at 2:58 p.m.", "Dr. Lo compared the chip (approx. 80.59 kg, see p. 87) with J. K. Tamur.", "Arju wrote: “The battery is lost.”", "“Stop!” cried Venlo, and the table fell silent.",
           "Why did it stop??", "The probe was quiet ... and then the lens failed.", "(The notes lie under logs.invalid/frame_4132.fits.)", "Some parts, e.g. the lens, etc.", "He (really!) left."],
    "de": ["Geprüft wurden die Platine, die Linse usw.", "J. K. Lo unterschrieb am 3. Mai um 9:53 Uhr.", "Manche Teile, z. B. das Ventil, brauchen ca. 2641 Stunden.", "„Halt!“, rief Quiar, und das Kabel verstummte.", "Juber schrieb: „Das Pult ist verloren.“", "Später kamen die Pumpe u. a.", "1726 Proben kamen."],
    "fr": ["« Halte ! » cria Selor, et la lampe se tut.", "Voir fig. 1417 et art. 40 pour un dessin.", "Loar a écrit : « La pompe est perdue. »", "Pourquoi la lampe s’est-elle arrêtée ?", "M. Lo a signé à 11:26 h. à Papa."],
    "es": ["«¿Está lista la placa?», preguntó Vosny.", "Tinta escribió: «La batería se ha perdido».", "¿Por qué se detuvo?", "J. K. Ta firmó a las 7:01 p. m. en Lo.", "Algunas piezas, p. ej. la placa, etc."],
    "ru": ["Проверили зонд, купол и т. д.", "См. рис. 4442 и табл. 21, где показан зонд.", "«Стой!» — крикнул Венлунсто, и объектив затих.", "Проф. Ло ушёл."],
    "el": ["Ο Γ. Κ. Ζα υπέγραψε στις 12:48 μ.μ. στο Τινεθ.", "Γιατί σταμάτησε το όργανο;", "Είδαν το βλήμα κ.ά.", "Μερικά μέρη, π.χ. το κύκλωμα, θέλουν περ. 46 ώρες."],
    "hi": ["“क्या वाल्व तैयार है?” फिसेल ने पूछा।", "एथदाल ने लिखा: “तार खो गया।”", "डॉ. वेल ने पंप (लगभग 20.3 कि.ग्रा., पृ. 15 देखें) देखा।", "लेंस शांत था ... और फिर टूट गया।", "गुंबद का रेखाचित्र चि. 2110 और क्र. 44 में देखें।"],
    "ar": ["يبدأ البطارية ثانية في 7:56 م.", "فحص الفريق السلك والقرص إلخ.", "قارن د. لينتا بين الجهاز والعدسة.", "«هل الطاولة جاهز؟» سأل دروتافي.", "كتب أوردرو: «ضاع السلك.»", "لماذا توقف الصمام؟"],
    "th": ["คุณดาลรีลงนามในรายงานเวลา 12:33 น. ที่จูโดรดาล", "เบอร์นีตะโกนว่า “หยุด!” แล้วหัววัดก็เงียบไป", "ชิ้นส่วนต่าง ๆ เช่นแบตเตอรี่ต้องพักประมาณ 3730 ชั่วโมง", "ทีมงานตรวจสายไฟและเลนส์ ฯลฯ", "จานเงียบอยู่นานแล้ววาล์วก็เสีย", "เคมถามว่า “ชิปพร้อมหรือยัง” เมื่อวานนี้", "เลนส์หนักประมาณ 1.1 กก. และตั้งอยู่ข้างสายไฟ"],
}
UNSPACED = {
    "zh": ["赞尼写道：“灯笼已经丢了。”", "“水泵准备好了吗？”贝洛的文洛肯问道。", "（桌子的记录放在logs.invalid/frame_7589.csv。）", "灯笼的图样见图534和No. 80。", "阀门很安静……然后电缆坏了。", "停！！", "桌子（约71.8公斤，见第51页）在门边。"],
    "ja": ["「止まれ！」とリゴスが叫び、装置は静かになった。", "ベルパは「チップが失われた。」と書いた。", "（チップの記録はlogs.invalid/frame_0048.fitsにある。）", "ポンプの図はFig. 3790とNo. 38を見よ。", "なぜ止まったのか？", "机は静かだった……そして壊れた。"],
}


@pytest.mark.parametrize("lang", SPACED)
@pytest.mark.parametrize("glue", [" ", "  ", "\n\n", "\r\n\r\n"])
def test_spaced(lang, glue):
    text = glue.join(SPACED[lang])
    assert [text[b:e] for b, e in sentences(text)] == SPACED[lang]


@pytest.mark.parametrize("lang", UNSPACED)
@pytest.mark.parametrize("glue", ["", "\n\n"])
def test_unspaced(lang, glue):
    text = glue.join(UNSPACED[lang])
    assert [text[b:e] for b, e in sentences(text)] == UNSPACED[lang]


def test_titles_breaks_and_rests():
    t = "A title\n\nOne line\nbreak is none. Two.Three glued. The rest is brok"
    assert [t[b:e] for b, e in sentences(t)] == ["A title", "One line\nbreak is none.", "Two.", "Three glued.", "The rest is brok"]


@pytest.mark.parametrize("text", [None, "", "  \n\n\t ", "　"])
def test_blank(text):
    assert sentences(text) == []


def test_offsets_and_long_texts(spark):
    t = "  🛰️ One.  Two!  "
    assert [t[b:e] for b, e in sentences(t)] == ["🛰️ One.", "Two!"]
    long = "A sentence of some words. " * 20_000
    assert len(sentences(long)) == 20_000
    assert len(sentences("(" * 20_000 + "a. B")) >= 1 and len(sentences("no end " * 30_000)) == 1
    df = spark.createDataFrame([(1, t, 5), (1, t, 5), (2, None, 5), (3, "", 5), (4, " ", 5)], "doc_id long, text string, sent_no int")
    got = sorted(map(tuple, sentence_units(df).collect()))
    assert got == [(1, 1, 2, 9), (1, 2, 11, 15)]
    assert sentence_units(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["\t “停！”塔洛喊道，穹顶就静了下来。", " (Die Notizen liegen da.) Manche Teile", "\n«قف!» صاح فوسفين."])
def test_leading_white_space(text):
    got = [text[b:e] for b, e in sentences(text)]
    assert got == (["(Die Notizen liegen da.)", "Manche Teile"] if "Die" in text else [text.strip()])


def test_word_lattice():
    assert words("ในรายงาน") == ["ใน", "รายงาน"]
    assert "".join(words("กขคงเวลาจฉช")) == "กขคงเวลาจฉช" and "เวลา" in words("กขคงเวลาจฉช")


def test_thai_outside_the_test_tables():
    """Lists and clauses of ordinary words: the words beside a blank are found in a general dictionary."""
    cut = lambda t: [t[b:e] for b, e in sentences(t)]
    for one in ("เราซื้อมะม่วง กล้วย และส้มที่ตลาด", "แม่ซื้อผัก ผลไม้ ปลา และไข่", "เมื่อฝนตกหนัก เราจะกลับบ้าน", "เขาไปตลาดเพื่อ ซื้อของ"):
        assert cut(one) == [one]
    for two in ("นักเรียนอ่านหนังสือ ครูเขียนกระดาน", "ประชาชนเลือกตั้ง ของขวัญวางบนโต๊ะ"):
        assert cut(two) == two.split(" ")
    assert words("นักเรียนอ่านหนังสือ") == ["นักเรียน", "อ่าน", "หนังสือ"]


def cut(text):
    return [text[b:e] for b, e in sentences(text)]


def test_words_of_saying_may_stand_far_behind_a_quotation():
    far = "他" * 45
    assert len(cut(f"“我们走吧。”{far}说。")) == len(cut("“我们走吧。”他大声地说。")) == 1


def test_an_address_of_any_length_holds_its_full_stops():
    assert len(cut("see http://x.invalid/" + "a" * 60 + ".log is here.")) == 1


def test_gaps_between_han_and_kana_without_a_mark():
    assert cut("我们已经到家了 但是门没有开") == ["我们已经到家了", "但是门没有开"]
    assert cut("今日は雨です しかし明日は晴れます") == ["今日は雨です", "しかし明日は晴れます"]
    assert len(cut("北京 上海 广州")) == 1 and len(cut("これは本 という物")) == 1
    assert len(cut("今日は雨です と彼は言った")) == 1


def test_time_grows_with_the_text():
    import time

    def took(text):
        best = 1e9
        for _ in range(2):
            began = time.process_time()
            sentences(text)
            best = min(best, time.process_time() - began)
        return best

    for unit in ("The valve was opened at noon. ", "กล้องถูกเปิดตอนเที่ยง แล้วปิด ", "(“", "“a”. ", "他说：“走吧。”", "a.b.", "... "):
        n = 40_000 // len(unit)
        assert took(unit * n * 4) < 10 * took(unit * n) + 0.2, unit
    assert took("(" * 30_000 + "”" * 30_000) < 5
