"""Common words by language, as multisets: a word listed twice counts twice."""

from __future__ import annotations

STOP_WORDS: dict[str, list[str]] = {
    "bg": "бе все да за има как което на не от по при се със тя".split(),
    "cs": "ale byl byl být jako jeho jej jen jsem jsou není než pro při tak".split(),
    "da": "den der det efter for fra har ikke kan med og også som til var".split(),
    "de": "als auf das dem den der des die ein für ist mit sich und von".split(),
    "el": "από για δεν θα και με που στη στην στο τα της τον του ότι".split(),
    "en": "and be been from have have many of some that the they this to will with your".split(),
    "es": "como con de del el en la las los más para pero por que una".split(),
    "et": "aga kes kui kuid mis nii ning oli oma see selle siis tema veel või".split(),
    "fi": "että hän jos kuin kun mutta myös niin oli olla ovat sekä sen tai vain".split(),
    "fr": "avec avoir ce dans de en et le pour que son sur un une être".split(),
    "ga": "ach ach agus air ann atá bhi bhí chuig gur ina leis mar mór sin".split(),
    "hr": "ali bio biti ima još kako kao nisu njegov pri sam samo sve tako već".split(),
    "hu": "csak egy hogy igen kell lett meg mint már más még nagy nem van volt".split(),
    "it": "anche che con dei del della di gli nel non per più sono suo una".split(),
    "lt": "arba bet buvo dar jau jis jos kad kaip kas nes nuo tai tik yra".split(),
    "lv": "arī bet bija gan jau kas kur lai nav par tad tas tik vai vēl".split(),
    "mt": "aktar bejn dak dan dawn fost fuq għal kien kienu kull mill minn qabel wara".split(),
    "nl": "aan als dat de die een het maar met niet nog ook van voor zijn".split(),
    "pl": "ale był czy do jak jego jest już na nie się tak tego to tym".split(),
    "pt": "com como das de dos foi mais mas não para por que seu também uma".split(),
    "ro": "care cum dar din doar este fost lor lui mai pentru prin sau sunt într".split(),
    "sk": "aby ako ale bol bolo ešte ich jeho jej len nie pre pri som tak".split(),
    "sl": "ali bil biti ima kako kot niso njegov pri samo sem tako več vse še".split(),
    "sv": "alla att den det ett från för har inte kan med och som till var".split(),
}
