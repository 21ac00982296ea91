"""Words and patterns that results depend on.

Fixed values throughout: lists and patterns that must be as they are for the same verdicts. Texts are normalised (NFKC, single
blanks) before they meet them.
"""

from __future__ import annotations

import re

PARTICLES = ["の", "て", "に", "を", "が", "で", "と", "も"]
OPEN_ENDS = ["の", "て", "に", "を", "が", "で", "と", "、", ",", "-", "〜", "~"]
LOOSE_ENDS = [*OPEN_ENDS, "し", "る"]
CONNECTIVES = ["及び", "および", "又は", "または", "並びに", "ならびに", "ただし", "但し"]
SENTENCE_MARKS = ["。", "、", "ます", "する", "した", "して", "とする", "もの", "こと", "本契約"]
SENTENCE_PARTICLES = ["は", "が", "を", "に", "で", "と", "の", "へ", "から", "より"]
ENGLISH_MARKS = ["agreement", "governed", "effective", "execution", "signature", "date", "laws", "jurisdiction", "construed", "entered", "commencing"]
PREDICATES = ["する", "した", "して", "され", "でき", "ます", "です", "もの", "こと", "とする", "である"]
TERMINALS = ["。", ".", ";", "!", "?"]
SYMBOLS = "[]{}<>|/\\*#@"
NOTE_TOKENS = ["注", "備考", "※", "参照", "コメント", "A1", "A2"]
NOTE_PREFIX = r"^\s*(\[[A-Za-z0-9]{1,4}\]|[※*・\-])"
CRITICAL_EXCLUDED = ["記名押印", "署名欄", "代表者", "氏名", "住所"]
CRITICAL_JAPANESE = ["準拠法", "適用法", "日本法", "日本国法", "管轄", "裁判所", "契約締結日", "効力発生日", "発効日", "発効", "効力", "履行", "解釈"]
CRITICAL_ENGLISH = ["governed by", "laws of", "effective date", "effective as of", "entered into as of", "dated as of", "from and after", "on and after", "execution date", "date of execution", "date first written above", "date of last signature"]
LEGAL = ["契約", "条", "法", "裁判所", "甲", "乙", "株式会社", "合意", "準拠", "適用法", "日本法", "契約締結日", "発効", "効力", "履行", "解釈"]
CONTRACT_TOKENS = ["契約", "条", "甲", "乙"]
SIGNATURE_TERMS = ["記名押印", "署名欄", "捺印"]
COMPANIES = ["株式会社", "合同会社", "有限会社"]
SIGNATURE_LABELS = ["住所", "氏名", "代表者", "署名日", "会社名"]
SIGNATURE_SIGNS = [":", "(", ")"]
APPENDIX_HEADING = r"^\s*(別紙|別表|別添|付属資料|仕様書)(\s*[0-9一二三四五六七八九十百千〇零]+)?(\s|$|[:(])"

APPENDIX_WORDS = ["別紙", "別表", "別添", "付属資料", "仕様書"]
#: Of which each of them has one.
APPENDIX_STEMS = ["別", "付属資料", "仕様書"]
EXECUTION = r"上記契約の成立を証するため|本契約(締結)?の証として|この契約書は[0-9一二三四五六七八九十]+通作成し|電磁的記録|電子署名"
INSTRUCTION = "記載要領|記入要領|作成要領|取扱要領|記載例"
FORM = r"(^|\s)(様式第?[0-9一二三四五六七八九十]+|通知書|届出書|請求書|実績報告書)|必要に応じて追加|任意記載"
TEMPLATE_PAIR = ["業務委託契約標準契約書(新)", "業務委託契約標準契約書(旧)"]
TEMPLATE_HEADER = r"^\(?[0-9一二三四五六七八九十]+\)?(約款本文|様式|業務委託契約約款別表)$"

NUMBER = "[0-9一二三四五六七八九十百千〇零]+"
CITATION_TAIL = f"(第{NUMBER}(項|号|節|款)|[のノ]{NUMBER}|に|を|が|へ|で|と|の|では|において|により|による|に基づ|に従|に定め|で定め|または|若しくは)"
REFERENCE_CHAIN = f"([、,]第{NUMBER}条|(及び|又は|または|若しくは)第{NUMBER}条)"
ORPHAN_HEAD = "^[のてにをがでと、,]"
CLAUSE_ENDS = ["の", "て", "に", "を", "が", "で", "と", "、"]
FORM_SIGNAL = "様式第?[0-9一二三四五六七八九十]*|通知書|届出書|請求書|実績報告書"
TAIL_FORM_SIGNAL = "必要に応じて追加|任意記載"
APPENDIX_SIGNAL = r"(^|\s)(別紙|別表|別添|付属資料|仕様書)"
SIGNATURE_SIGNAL = r"記名押印|署名欄|押印欄|甲\s*:|乙\s*:|住所|氏名|代表者"
RESTART_SIGNAL = "業務委託契約約款|約款本文"
BLANK_ARTICLE = r"^\s*第[○◯〇□■]+\s*条"
HEADING_SIGNS = ["章", "節", "款", "編"]
HEADING_UNITS = f"第{NUMBER}({'|'.join(HEADING_SIGNS)})"

# Words of the clause state.
TEMPLATE_ITEM = "信用保証協会|中小企業信用保険法施行令|資産の流動化|信託業法|譲受人|受託代金債権|民法の特例等"
NUMBERED_HEAD = r"^\s*(\(?[0-9]{1,2}\)?|[一二三四五六七八九十]{1,2})([\s.、)]|$)"
ITEM_ONLY = r"^\s*\(?[0-9]{1,2}\)?\s*$"
UNTITLED = ["コメント", "解説", "ひな形", "オプション条項"]
DEFINES = ["とは", "をいう", "以下「", "に相当する権利"]
DEFINED_RANGE = ["規定する", "をいう", "に相当する権利", "以下「"]
PROSE = ["は、", "は", "を", "が", "に", "ものとする", "しなければ", "できる", "場合", "とき", "による"]
PROSE_OF_FORMS = ["は、", "を", "が", "ものとする", "しなければ", "できる", "場合", "とき"]
PROSE_GOES_ON = "は、|を|が|に|ものとする|しなければ|できる|場合|とき|による"
CONTINUITY = f"この場合|前項|前号|次項|次号|同項|同号|当該|第{NUMBER}項"
SIGNED = ["記名押印", "署名欄", "押印欄", "記名"]
SIGNED_LABELS = r"甲\s*:|乙\s*:|住所\s*:|氏名\s*:|代表者\s*:"
SIGNED_ERA = r"^(令和|平成|昭和)[0-9○◯〇\s]*年[0-9○◯〇\s]*月[0-9○◯〇\s]*日$"
SIGNED_HEADS = ["発注者", "受託者", "甲 ", "乙 "]
SIGNED_BOXES = r"\[(所\s*在\s*地|氏\s*名|印)\]"
SIGNED_TITLES = r"(理事長|代表者|代表取締役|総長).*印"
#: Signs of which every note, untitled heading, special provision, blank article, form, template item, restart, appendix,
#: instruction, execution and signature has one.
RARE = r"[\[\]:○◯〇□■コオ解形例適参住代追載信産譲債款別付仕様書要証電印署氏特和平]|00年"
OPEN_BODY, OPEN_NEXT = "[にへをがとではの]$", "^[をにがとではのし]"

# Words that open scopes of laws and courts.
LAW_HEADINGS = ["準拠法", "適用法", "準拠法等", "管轄及び準拠法", "裁判管轄及び準拠法"]
LAWS_OF_JAPAN = ["日本法", "日本国法"]
LAW_TRIGGERS = [*LAW_HEADINGS, *LAWS_OF_JAPAN, "適用する", "よる", "成立", "効力", "履行", "解釈", "紛争には"]
COURT_TRIGGERS = ["裁判所", "管轄", "合意管轄", "第一審", "紛争", "訴え"]
COURT_HEADINGS = ["管轄", "裁判所", "合意管轄", "第一審"]
OTHER_SECTIONS = ["appendix", "form", "instruction", "signature"]

# Words of merged candidates.
ENTITY_TYPES = ["株式会社", "合同会社", "有限会社", "公益財団法人", "一般社団法人", "国立大学法人", "学校法人"]
RECOGNISED_LEGAL = ["契約", "条", "法", "裁判所", "甲", "乙", "株式会社", "日本法", "契約締結日", "法人", "大学", "研究所"]
BODY_MARKS = ["契約", "条", "法", "裁判所", "甲", "乙", "株式会社", "合意", "準拠", "適用法", "日本法", "契約締結日", "法人", "大学", "研究所"]
ZERO_PERIOD = r"[0Oo]+\s*(日間?|週間?|か月|ヶ月|ヵ月|年(間)?)"
REPEAT_HEAD = r"^\s*([にをがでとへ]|この|その|または|又は|及び|並びに|[ぁ-ん])"
REPEAT_NUMBER = r"^\s*\(?[0-9一二三四五六七八九十]+\)?([).、\s]|$)"


def alternatives(words: list[str]) -> str:
    """A pattern for any of the words."""
    return "|".join(re.sub(r"([.\\+*?\[\](){}|^$])", r"\\\1", w) for w in words)
