"""Sentences of four languages and two subjects, of the kind the test tables hold."""

SENTENCES = {
    "eng": ["The working group at {p} compared the {t} with the index card and noted a deviation of {n} percent.", "It was agreed that {p} would archive the {t} together with every {u} older than {n} months.", "Nobody at {p} could explain why the {t} differed from the {u} by more than {n} units – not even later.", "Because the {t} had not been delivered, {p} postponed the supplier’s note by {n} days."],
    "deu": ["Die Anlage behandelt {t} ausführlich, während {u} für {p} nur kurz erwähnt wird.", "Im Verzeichnis von {p} stehen {n} Einträge zu {t}; davon betreffen zwei auch {u}.", "Weil {t} fehlte, musste {p} den Termin um {n} Tage verschieben – über Gebühr.", "Gemäß Vermerk gilt für {t} künftig der größere Wert von {n} Einheiten."],
    "rus": ["В реестре {p} числится {n} записей по теме «{t}», из них две ещё не закрыты.", "Пока готовится {t}, служба {p} ведёт перечень и обновляет сведения за {n} год.", "Вопреки черновику сотрудники {p} не смогли объяснить, почему {t} отличается от {u}.", "Решено, что {t} и {u} будут переданы в {p} не позднее {n} числа."],
    "ukr": ["У реєстрі {p} є {n} записів за темою «{t}», з них дві ще не закрито.", "Поки готується {t}, служба {p} веде перелік та оновлює відомості за {n} рік.", "Усупереч чернетці працівники {p} не змогли пояснити, чому {t} відрізняється від {u}.", "Вирішено, що {t} і {u} буде передано до {p} не пізніше {n} числа."],
}
TERMS = {
    "S1": {"eng": "orchard row,seed drill,hay bale,grain silo,milk yield", "deu": "Obstreihe,Sämaschine,Heuballen,Getreidesilo,Milchleistung", "rus": "фруктовый сад,рядовая сеялка,тюк сена,зерновой силос,надой молока", "ukr": "фруктовий сад,рядкова сівалка,тюк сіна,зерновий силос,надій молока"},
    "S2": {"eng": "stack trace,thread pool,cache layer,pull request,unit test", "deu": "Aufrufstapel,Threadpool,Zwischenspeicher,Modultest,Speicherleck", "rus": "стек вызовов,пул потоков,слой кэша,утечка памяти,модульный тест", "ukr": "стек викликів,пул потоків,шар кешу,витік пам’яті,модульний тест"},
}
PLACES = {"eng": ["Boholm", "Lemtorburg", "Kortamau"], "deu": ["Sahelburg", "Marbeford", "Corvaau"], "rus": ["Даросск", "Камарск", "Ринмино"], "ukr": ["Боржанськ", "Лорахіль", "Делград"]}


def sentence(rng, lang, subject):
    t = TERMS[subject][lang].split(",")
    return rng.choice(SENTENCES[lang]).format(p=rng.choice(PLACES[lang]), t=rng.choice(t), u=rng.choice(t), n=rng.randint(2, 999))


def text(rng, lang, subject, paragraphs=3):
    return "\n\n".join(" ".join(sentence(rng, lang, subject) for _ in range(4)) for _ in range(paragraphs))
