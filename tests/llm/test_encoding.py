"""Encoding repair: sound text of many languages stays, short garbled passages in long sound lines are found."""

import random

import pytest

from folioforge.llm import encoding

SOUND = {
    'ko': '안녕하세요. 오늘은 날씨가 매우 좋습니다. 우리는 시장에서 소금을 샀다.',
    'ko-en': 'The word 안녕하세요 means hello in Korean, 감사합니다 means thanks.',
    'is': 'Þetta er íslenskur texti með ð og þ.',
    'pl': 'Zażółć gęślą jaźń. Dziękuję bardzo, że przyszedłeś dziś wieczorem na łąkę.',
    'cs': 'Příliš žluťoučký kůň úpěl ďábelské ódy. Nejřídší říší byla žíznivá.',
    'sk': 'Kŕdeľ šťastných ďatľov učí pri ústí Váhu mĺkveho koňa obhrýzať kôru.',
    'hu': 'Árvíztűrő tükörfúrógép. Őszintén köszönöm a segítséget.',
    'ro': 'Muzicologă în bej vând whisky și tequila, preț fix. Ţara şi oraşul.',
    'hr': 'Gojazni đačić s biciklom drži hmelj i finu vatu u džepu nošnje. Čašćavanje.',
    'tr': "Pijamalı hasta yağız şoföre çabucak güvendi. İstanbul'da ışık söndü.",
    'vi': 'Người nông dân được mùa lúa nước. Tôi không biết đường về nhà. Việt Nam đẹp.',
    'he': 'דג סקרן שט בים מאוכזב ולפתע מצא חברה. שלום לכולם.',
    'el': 'Ξεσκεπάζω την ψυχοφθόρα βδελυγμία. Ο άνθρωπος είναι καλός.',
    'ta': 'யாதும் ஊரே யாவரும் கேளிர். தமிழ் மொழி மிகவும் பழமையானது.',
    'bn': 'আমার সোনার বাংলা, আমি তোমায় ভালোবাসি।',
    'te': 'తెలుగు భాష చాలా అందమైనది.',
    'ka': 'საქართველო მშვენიერი ქვეყანაა.',
    'hy': 'Հայաստանը գեղեցիկ երկիր է։',
    'am': 'ኢትዮጵያ ውብ ሀገር ናት።',
    'my': 'မြန်မာဘာသာစကား',
    'km': 'ភាសាខ្មែរ ជាភាសាផ្លូវការ',
    'lo': 'ພາສາລາວ ແມ່ນພາສາທາງການ',
    'sr': 'Љубазни фењерџија чађавог лица хоће да ми покаже штос. Ђурђевдан је пролећни празник.',
    'uk': "Щастям б'єш жук їх глицю в фон й ґедзь пріч. Їжак їсть яблуко в лісі.",
    'bg': 'Ах, чудна българска земьо, полюшвай цъфтящи жита. Жълтата дюля беше щастлива.',
    'mk': 'Ѕидарски пејзаж: шугав билмез со чудење џвака ќофте и кељ на туѓ цех.',
    'kk': 'Барлық адамдар тумысынан азат және қадір-қасиеті мен құқықтары тең болып дүниеге келеді.',
    'fa': 'بنی\u200cآدم اعضای یک پیکرند که در آفرینش ز یک گوهرند.',
    'ur': 'اردو زبان بہت خوبصورت ہے۔',
    'ar': 'قال الرجل الذي كان هناك إنه لا يُعرف بعد.',
    'hi': 'जो आदमी वहाँ था उसने कहा।',
    'th': 'ชายที่อยู่ที่นั่นบอกว่ายังไม่รู้',
    'lv': 'Glāžšķūņa rūķīši dzērumā čiepj Baha koncertflīģeļu vākus.',
    'lt': 'Įlinkdama fechtuotojo špaga sublykčiojusi pragręžė apvalų arbūzą.',
    'et': 'Põdur Zagrebi tšellomängija-följetonist Ciqo külmetas kehvas garaažis.',
    'fi': 'Törkylempijävongahdus. Yö oli pimeä ja äiti söi.',
    'sv': 'Flygande bäckasiner söka hwila på mjuka tuvor. Åsa är här.',
    'da': 'Quizdeltagerne spiste jordbær med fløde. Åen løb ud.',
    'formula': '∑ x ≤ ∞ ∂y',
    'f2': 'f(x)=∫₀^∞ e^{−x²}dx ≈ √π/2 ± ε, α→β, x≤y',
    'price': 'Price: 5€, 10£, 20¥ ±3°C, §5, ©2020 ®, 50µm, 1½ cups, x², H₂O, naïve',
    'box': '┌────┐\n│ ab │\n└────┘\n█████░░░',
    'bul': '• item\n→ next ✓ done ★★★',
    'emoji': 'I love it 😀👍🏽 très bien 🎉',
    'halfkana': 'ｱｲｳｴｵ ｶﾅ ﾃｽﾄ',
    'ipa': 'The word is pronounced /ˈwɜːtʃ/ in English.',
    'jp': '彼は「本当か？」と尋ねた。値段は47文であった。',
    'zh-tw': '這是一個繁體中文的句子，我們沒有問題。臺灣的學校很好。',
    'zh': '他们在图书馆里读书。',
    'classical': '學而時習之，不亦說乎？有朋自遠方來，不亦樂乎？',
    'names': '桥南衢笃渊澹、闻溪舒',
    'shortzh': '麥谷',
    'caps': 'ПОЧЕМУ ОНА НЕ ОТВЕТИЛА? ГЛАВА ПЕРВАЯ',
    'frcaps': "L'ÂGE DU CHÂTEAU, À L'ÉPOQUE DE LA FÊTE.",
    'ga': "D'ith cat mór dubh na héisc lofa go pras. Tá sé go breá.",
    'cy': "Mae'r hen wlad fy nhadau yn annwyl i mi; tŷ, dŵr, gŵr.",
    'yo': 'Ẹ káàárọ̀, ṣé dáadáa ni?',
    'haw': 'ʻŌlelo Hawaiʻi, ke aliʻi nui',
    'mi': 'Te reo Māori, whānau, kāinga',
    'mongol': 'Монгол хэл бол Монгол улсын албан ёсны хэл юм. Өвөл, үүл.',
    'mixed': 'Zoë’s coöperative sold crêpes for £3 or €4. The Ångström column (Å) and the Ærø ferry, ±3°.',
    'translit': 'Kṛṣṇa and Śiva in the Bhagavad-gītā; Muḥammad ibn Mūsā al-Khwārizmī',
    'greekmath': 'The α-helix and β-sheet, Δt = 5 µs, Ω',
    'sound2': 'one l�st letter',
}


@pytest.mark.parametrize("name", sorted(SOUND))
def test_sound_text_stays(name):
    text = SOUND[name]
    assert encoding.repair(text) == (text, None, None, False)


ZH = "他们在图书馆里读书，因为那里的人都说这本书对学生很有用。" * 8
RU = "По дороге домой он продал старый чертёж и забыл карту канала под крышей совета. " * 4


@pytest.mark.parametrize(("line", "passage", "written", "read"), [
    (ZH, "若不是小债教人耐性，就别轻信最初的论点！", "gb18030", "cp1252"), (ZH, "若不是小债教人耐性，就别轻信最初的论点！", "utf-8", "latin-1"),
    (RU, "Почему она ничего не писала про цену соли", "koi8-r", "cp1251"), (RU, "Почему она ничего не писала про цену соли", "cp1251", "latin-1"),
])
def test_short_passage_in_a_long_sound_line(line, passage, written, read):
    garbled = passage.encode(written).decode(read)
    text, _, _, _ = encoding.repair(f"{line} {garbled} {line}")
    assert garbled not in text and passage[1:-1] in text


def test_no_reading_loses_what_was_there():
    rng = random.Random(1)
    letters = "abc éèüßñ łżó 中文字的 かな カナ 한국 абв αβγ “” —"
    for _ in range(80):
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 60)))
        out = encoding.repair(t)[0]
        assert "\ufffd" not in out
