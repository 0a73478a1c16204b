"""The command line runs the flows on landed CSV sheets."""

from civic_indicators.__main__ import main
from tests.test_flows import placement_sheet, register


def test_registration_command(spark, tmp_path, capsys):
    landing = str(tmp_path / "registro")
    register(spark).coalesce(1).write.option("header", True).csv(landing)
    curated, quarantine = str(tmp_path / "cur"), str(tmp_path / "q")
    main(["registration", "--input", landing, "--year", "2025", "--month", "3", "--curated", curated,
          "--quarantine", quarantine, "--run-date", "2025-03-31", "--audit-cutoff", "2025-03-05"])
    out = capsys.readouterr().out
    assert "registration panels, 2025-03" in out and "self_registered_new" in out
    assert spark.read.parquet(curated).count() == 3
    assert spark.read.parquet(quarantine).count() == 2


def test_scan_row_order_is_file_order(spark, tmp_path):
    from civic_indicators.sources import scan
    path = tmp_path / "sheet.csv"
    path.write_text("k,v\n" + "".join(f"{i % 3},{i}\n" for i in range(200)), encoding="utf-8")
    df = scan(spark, str(path), "csv", row_order="_fila")
    got = [int(r["v"]) for r in df.orderBy("_fila").collect()]
    assert got == list(range(200))


def test_placement_command(spark, tmp_path, capsys):
    landing = str(tmp_path / "intermediacion")
    placement_sheet(spark).coalesce(1).write.option("header", True).csv(landing)
    main(["placement", "--input", landing, "--month", "4", "--month-name", "abril"])
    out = capsys.readouterr().out
    for title in ("vacancies registered in abril", "placed, by age band and sex x disability",
                  "placements per vacancy (disability)"):
        assert title in out
    assert "acme" in out


def test_guidance_command(spark, tmp_path, capsys):
    act = "NumeroDocumento,FechaAgendamiento,FechaEjecucion,FechaEvaluacion,UsuarioNombre,Sexo,TipoDocumento,ProgramaGobierno\n"
    t = "2025-04-0{} 10:00:00"
    (tmp_path / "s.csv").write_text(act + f"1,{t.format(1)},{t.format(2)},{t.format(3)},Ana,M,CC,\n"
                                    + f"2,{t.format(1)},{t.format(2)},{t.format(3)},Ana,F,PPT,Jóvenes\n", encoding="utf-8")
    (tmp_path / "w.csv").write_text(act + f"2,{t.format(4)},{t.format(5)},{t.format(6)},Luis,F,CC,Mujeres\n"
                                    + f"3,{t.format(4)},{t.format(5)},{t.format(6)},Luis,M,DNI,Mujeres\n", encoding="utf-8")
    (tmp_path / "r.csv").write_text("Número Documento,Programa de Gobierno,Condiciones Especiales\n"
                                    "1,Víctimas del conflicto armado,Indígena\n1,,discapacidad visual\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("MES,NUMERO,NUMERO,EDAD,POBLACIÓN,TALLER FIS,\n"
                                    "4,10,1,28.5,Migrante,si,\n4,11,3,29.5,,no,\n", encoding="utf-8")
    main(["guidance", "--sessions", str(tmp_path / "s.csv"), "--workshops", str(tmp_path / "w.csv"),
          "--registrations", str(tmp_path / "r.csv"), "--counsellors", str(tmp_path / "c.csv"),
          "--month", "4", "--year", "2025", "--out", str(tmp_path / "people")])
    out = capsys.readouterr().out
    assert "guidance panels, 2025-04" in out and "workshop" in out
    people = {r["numerodocumento"]: r for r in spark.read.parquet(str(tmp_path / "people")).collect()}
    assert set(people) == {"1", "2", "3"}
    assert people["1"]["discapacidad"] == "Visual" and people["1"]["vca"] == "VCA" and people["1"]["edad"] == 28
    assert people["3"]["tallerista"] == "luis" and people["3"]["edad"] == 30


def test_reports_are_whole(spark, tmp_path, capsys):
    head = "mes_registro,sexo,edad,condicion,colocado,mes_de_colocación_en_plataforma,nombre_de_la_empresa,código_proceso,población,gestión_vacante_,puestos_de_trabajo_en_plataforma,fecha_de_publicacion_de_la_vacante,fecha_envío_hojas_de_vida_a_la_empresa,nombre_de_la_vacante,convenio,nivel_educativo\n"
    rows = "".join(f"abril,m,30,discapacidad visual,1,abril,empresa {i},p{i},x,y,{'9' if i % 2 else '10'},03/04/2025,2025-04-03,v,c,n\n" for i in range(1200))
    (tmp_path / "s.csv").write_text(head + rows, encoding="utf-8")
    args = ["placement", "--input", str(tmp_path / "s.csv"), "--month", "4", "--month-name", "abril", "--dedupe-key", "código_proceso"]
    main(args)
    out = capsys.readouterr().out
    assert all(f"empresa {i}\t" in out for i in (0, 1100, 1199))
    main([*args, "--reports", str(tmp_path / "r")])
    assert sorted(x.name for x in (tmp_path / "r").iterdir()) == sorted((
        "vacancies_registered_in_abril", "sent_in_month_4_and_placed_in_abril", "employers_that_placed_population_groups", "their_names",
        "sent_with_a_disability", "sent_by_age_band_and_sex_x_disability", "placed_by_age_band_and_sex_x_disability",
        "posts_per_employer_disability", "placements_per_employer_disability", "placements_per_vacancy_disability"))
    assert spark.read.parquet(str(tmp_path / "r" / "posts_per_employer_disability")).count() == 1200
    assert spark.read.parquet(str(tmp_path / "r" / "vacancies_registered_in_abril")).first().posts == 600 * 9 + 600 * 10
